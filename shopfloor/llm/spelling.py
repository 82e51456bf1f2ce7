"""Spelling variants: words one letter apart, found in tries of letter counts.

A word's vector is its length and how often it has letters of each group, the commonest letters first. Words
that differ by one letter have vectors that differ by one surplus and one deficit at most. The vectors of a
shard form a trie, a level for each group; every word walks down it depth first, and may spend a surplus of
one and a deficit of one on the way (a word one letter longer: just a surplus). What it meets at the leaves
is verified letter by letter.

A shard is one length and one choice of the first counts. A word lies in its own shard and asks all that its
budget can reach; how many counts name a shard follows the number of words, and shards that very many words
ask are split by them. A word's form is its commonest near word, if that is at least twice as common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm.ship import mapped
from shopfloor.operators.joins import small
from shopfloor.session import stage

#: Letters in the order of their levels, the commonest first; all others share ``OTHERS`` levels after them.
ORDER = "etaoinsrhldcumfpgwybvkxjqz"
OTHERS = 6
GROUPS = len(ORDER) + OTHERS
#: Partial walks that a task holds at a time, and asking words that one part of a shard has at most, about.
WALKS, ASKING = 1 << 18, 1 << 18
MANGLE, LEAST_LETTERS, LEAST_SEEN = 97, 5, 3

_GROUP = np.array([ORDER.index(chr(b)) if chr(b) in ORDER else len(ORDER) + b % OTHERS for b in range(256)])


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mangle: int = MANGLE, letters: int = LEAST_LETTERS, seen: int = LEAST_SEEN) -> DataFrame:
    """(``word``, ``n``) of all words of at least ``letters`` code points that occur ``seen`` times or more.

    Words are maximal runs of Latin letters, A to Z lower-cased. If ``mangle`` divides the crc32 of
    ``<id>:<run>``, the run loses the letter that this hash names.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("run"),
    ).where(F.char_length("run") >= letters)
    # lower() is quick, but right only where all is ASCII.
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(F.translate("run", upper, upper.lower()))
    hashed = runs.select("id", low.alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % mangle == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= seen)


def vectors(words: list[bytes]) -> np.ndarray:
    """Length and counts of letter groups of words in Latin-1."""
    sizes = np.array([len(w) for w in words], np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    group = _GROUP[np.frombuffer(b"".join(words), np.uint8)]
    counts = np.bincount(row * GROUPS + group, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    return np.concatenate([sizes[:, None], counts], axis=1).astype(np.int32)


class Trie:
    """Vectors as paths, a level for each count from ``skip`` on; a node is known by its place in its level."""

    def __init__(self, vectors: np.ndarray, skip: int):
        self._levels, self._base = [], int(vectors.max(initial=0)) + 3
        node = np.zeros(len(vectors), np.int64)
        for column in vectors.T[skip:]:
            keys, node = np.unique(node * self._base + column + 1, return_inverse=True)
            self._levels.append(keys)
        self.rows = np.argsort(node, kind="stable")
        self.first = np.searchsorted(node[self.rows], np.arange(len(self._levels[-1]) + 1))
        self._skip = skip

    def met(self, vectors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (asking vector, row at a leaf) within what each asking vector has left to spend.

        All that it may spend is spent evenly: a walk that ends with one of a surplus and a deficit left over is
        no pair, for lengths would not agree.
        """
        at = np.arange(len(vectors))
        stack = [(0, at[k : k + WALKS // 8], np.zeros(len(at[k : k + WALKS // 8]), np.int64), surplus[k : k + WALKS // 8], deficit[k : k + WALKS // 8]) for k in range(0, len(at), WALKS // 8)]
        while stack:
            level, ask, node, more, less = stack.pop()
            if level == len(self._levels):
                fits = more == less
                ask, node = ask[fits], node[fits]
                each = self.first[node + 1] - self.first[node]
                place = np.repeat(self.first[node], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                yield np.repeat(ask, each), self.rows[place]
                continue
            keys, want = self._levels[level], vectors[ask, self._skip + level]
            steps = []
            for change in (0, 1, -1):
                may = np.arange(len(ask)) if change == 0 else np.flatnonzero(more > 0 if change > 0 else less > 0)
                key = node[may] * self._base + want[may] + 1 + change
                to = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                there = keys[to] == key
                may, to = may[there], to[there]
                steps.append((ask[may], to, more[may] - (change > 0), less[may] - (change < 0)))
            joined = [np.concatenate(c) for c in zip(*steps)]
            for k in range(0, len(joined[0]), WALKS):
                stack.append((level + 1, *(c[k : k + WALKS] for c in joined)))


def _one_apart(asks: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which rows of ``asks`` (words of one length, as bytes) are one letter from the rows of ``own``, as long or one letter longer."""
    if asks.shape[1] == own.shape[1]:
        return (asks != own).sum(axis=1) == 1
    ahead = asks == own[:, :-1]
    same = np.where(ahead.all(axis=1), asks.shape[1], ahead.argmin(axis=1))  # letters before the first that differs
    behind = (asks == own[:, 1:])[:, ::-1]
    rest = np.where(behind.all(axis=1), asks.shape[1], behind.argmin(axis=1))
    return same + rest >= asks.shape[1]


def near_in_shard(asks: list[bytes], ask_n: np.ndarray, own: list[bytes], own_n: np.ndarray, skip: int) -> tuple[np.ndarray, ...]:
    """(word, number of near words, the commonest's n, the commonest) for words of one part of a shard.

    Both words of a pair are told of it if the asking one is shorter, else the asking one alone: the other asks too.
    """
    size, vector = len(own[0]), vectors(own)
    trie, asking = Trie(vector, skip), vectors(asks)
    short = asking[:, 0] < size
    apart = vector[0, :skip] - asking[:, :skip]  # what the way to the shard has spent; all in it start alike
    more = 1 - np.maximum(apart[:, 1:], 0).sum(axis=1)
    less = np.where(short, 0, 1) - np.maximum(-apart[:, 1:], 0).sum(axis=1)
    codes = np.frombuffer(b"".join(own), np.uint8).reshape(-1, size)
    lengths = asking[:, 0]
    at = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(asks), np.uint8)
    found = []
    for ask, row in trie.met(asking, more, less):
        for k in range(0, len(ask), max(1, (1 << 23) // size)):
            a, r = ask[k : k + max(1, (1 << 23) // size)], row[k : k + max(1, (1 << 23) // size)]
            for of in (short[a], ~short[a]):
                if of.any():
                    i, j = a[of], r[of]
                    letters = data[at[i][:, None] + np.arange(lengths[i[0]])]
                    ok = _one_apart(letters, codes[j])
                    found.append((i[ok], j[ok]))
    if not found:
        return (np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
    i, j = (np.concatenate(c) for c in zip(*found))
    names, n = np.array([*asks, *own], object), np.concatenate([ask_n, own_n])
    back = short[i]
    x, y = np.concatenate([i, j[back] + len(asks)]), np.concatenate([j + len(asks), i[back]])
    order = np.lexsort((np.argsort(np.argsort(names))[y], -n[y], x))
    x, y = x[order], y[order]
    who, first, times = np.unique(x, return_index=True, return_counts=True)
    return names[who], times, n[y[first]], names[y[first]]


def _prefixes(n: int) -> int:
    """How many counts, after the length, name a shard for n words."""
    return min(2 + max(0, n.bit_length() - 20), 10)


def near_words(words: DataFrame, n_words: int | None = None, asking: int = ASKING) -> DataFrame:
    """(``word``, ``n_near``, ``form_n``, ``form``): the number of near words and the commonest, ties by code points; only words that have some."""
    depth = _prefixes(words.count() if n_words is None else n_words)
    shard_type = T.StructType([T.StructField("shard", T.BinaryType()), T.StructField("asks", T.BooleanType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 8192):
                part = batch.slice(k, 8192)
                lead = vectors([w.encode("latin-1") for w in part.column("word").to_pylist()])[:, : depth + 1]
                row, shard = [np.arange(len(lead))], [lead]
                for longer in (0, 1):
                    for up in range(depth + 1):  # 0: none of these counts
                        for down in range(depth + 1) if not longer else (0,):
                            if up == down and up:
                                continue
                            to = lead.copy()
                            to[:, 0] += longer
                            to[:, up] += 1 if up else 0
                            to[:, down] -= 1 if down else 0
                            able = (to >= 0).all(axis=1)
                            row.append(np.flatnonzero(able))
                            shard.append(to[able])
                rows = pa.array(np.concatenate(row))
                asks = np.arange(len(rows)) >= len(lead)
                names = pa.array([s.tobytes() for s in np.concatenate(shard)], pa.binary())
                yield pa.RecordBatch.from_arrays([names, pa.array(asks), part.column("word").take(rows), part.column("n").take(rows)], shard_type.names)

    dealt = mapped(words.select("word", "n"), deal, shard_type)
    sizes = dealt.groupBy("shard").agg(F.count_if(~F.col("asks")).alias("_own"), F.count_if("asks").alias("_asking")).where("_own > 0")
    parts = stage(sizes.select("shard", F.greatest(F.ceil(F.col("_asking") / F.lit(asking)), F.lit(1)).cast("int").alias("parts")), "spelling-shards")
    known = dealt.join(small(parts), "shard")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    one = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    split = known.select("shard", "asks", "word", "n", F.explode(F.when(F.col("asks"), one).otherwise(every)).alias("part"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        own, asks = group[~group["asks"]], group[group["asks"]]
        coded = lambda f: [w.encode("latin-1") for w in f["word"]]
        if not len(asks):
            asks = group[:0]
        found = near_in_shard(coded(asks), asks["n"].to_numpy(), coded(own), own["n"].to_numpy(), depth + 1)
        text = lambda c: np.array([w.decode("latin-1") for w in c], object)
        return pd.DataFrame({"word": pd.Series(text(found[0]), dtype=object), "n_near": found[1], "form_n": found[2], "form": pd.Series(text(found[3]), dtype=object)})

    pieces = split.groupBy("shard", "part").applyInPandas(join, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return pieces.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select("word", "n_near", (-F.col("_best.less")).alias("form_n"), F.col("_best.form").alias("form"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mangle: int = MANGLE, letters: int = LEAST_LETTERS, seen: int = LEAST_SEEN, factor: int = 2) -> DataFrame:
    """One row per word of ``counted``: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    ``form`` is the near word of the largest n (ties: the first by code points), if that n is at least ``factor``
    times the word's; else it and ``form_n`` are null. ``root`` is where forms lead to, the word itself if it has
    none. A null text has no words and a null id counts as empty; repeated rows count as often as they occur; no
    rows give no rows. Other columns are not read.
    """
    words = stage(counted(docs, doc_id, text, mangle, letters, seen), "spelling-words")
    near = stage(near_words(words), "spelling-near")
    known = words.join(near, "word", "left")
    has = F.col("form_n") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"))
    known = stage(known, "spelling-forms")
    ways = stage(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    # A form is at least twice as common, so the ways are short; each round doubles what has been walked.
    while not (going := ways.join(small(ways.select(F.col("word").alias("root"), F.col("root").alias("_further"))), "root", "left")).where("_further IS NOT NULL").isEmpty():
        ways = stage(going.select("word", F.coalesce("_further", "root").alias("root")), "spelling-roots")
    return known.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))
