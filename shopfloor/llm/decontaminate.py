"""Benchmark passages in documents, by a prefix-filtered set join with exact verification.

A benchmark item is cut into windows of ``WINDOW_WORDS`` consecutive words (a shorter item is one
window). A window is the set of its shingles. Since a window must occur whole, one shingle of it is a
sufficient prefix: the one that is rarest over all documents. Documents are joined to the windows on
these shingles; the shingle's place in the window fixes where the window would have to lie (positional
bound), which must be inside the document (length bound); then all its words are compared.

The index is made for blocks of the benchmark of bounded size. One pass over the documents counts the
shingles of a block, another one joins. A larger benchmark takes more passes, not more memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shopfloor.llm import words
from shopfloor.llm.ship import beside, mapped, named
from shopfloor.session import stage

WINDOW_WORDS = 13
SHINGLE_WORDS = 4
#: Bytes of benchmark text in one block, at most (or one item).
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 20


class Words:
    """The words of the texts of one slice, with hashes of any run of them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = words.LOWER[data]
        self.starts, self.ends, self.firsts = words.find(self.data, offsets, words.ALNUM)
        self._hash = words.Hasher(words.Hasher.of_bytes(self.data)(self.starts, self.ends))
        self.counts = np.diff(self.firsts)
        self.row_end = np.repeat(self.firsts[1:], self.counts)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of n words within a text, and the runs' hashes."""
        at = np.arange(len(self.starts))
        at = at[at + n <= self.row_end]
        return at, self._hash(at, at + n)

    def hashes(self, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return self._hash(at, at + lengths)

    def text(self, at: int, to: int) -> bytes:
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.starts[at:to].tolist(), self.ends[at:to].tolist())])


@dataclass
class Windows:
    """All windows of one block: item number, length, hash and text; and the shingles of each."""

    item: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    text: list[bytes]
    #: For each (window, shingle) pair: the window, the shingle's place in it, its words and its hash.
    pair: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def windows_of(texts: list[str | None], window_words: int, shingle_words: int) -> Windows:
    column = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    parts, pairs, done, n_items = [], [], 0, 0
    for _, data, offsets in words.slices(column, "t"):
        own = Words(data, offsets)
        sizes = np.minimum(own.counts, window_words)
        per_item = np.where(own.counts == 0, 0, own.counts - sizes + 1)
        item = np.repeat(np.arange(len(own.counts)), per_item)
        first = own.firsts[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
        length = sizes[item]
        parts.append((item + n_items, length, own.hashes(first, length), [own.text(a, a + n) for a, n in zip(first.tolist(), length.tolist())]))
        shingle = np.minimum(length, shingle_words)
        per_window = length - shingle + 1
        window = np.repeat(np.arange(len(item)), per_window)
        place = np.arange(len(window)) - np.repeat(np.cumsum(per_window) - per_window, per_window)
        pairs.append((window + done, place, shingle[window], own.hashes(first[window] + place, shingle[window])))
        done, n_items = done + len(item), n_items + len(own.counts)
    if not parts:
        none = np.zeros(0, np.int64)
        return Windows(none, none, none.astype(np.uint64), [], (none, none, none, none.astype(np.uint64)))
    joined = [np.concatenate(x) for x in list(zip(*parts))[:3]]
    return Windows(*joined, [t for p in parts for t in p[3]], tuple(np.concatenate(x) for x in zip(*pairs)))


class Keys:
    """A sorted set of hashes, and which of them occur among others."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = hashes
        self._filter = np.zeros(1 << _FILTER_BITS, bool)
        self._filter[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def among(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are keys, and the keys' numbers."""
        at = np.flatnonzero(self._filter[hashes & np.uint64((1 << _FILTER_BITS) - 1)])
        if not len(at):
            return at, at
        key = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        same = self.sorted[key] == hashes[at]
        return at[same], key[same]


def shingle_counts(docs: DataFrame, text: str, hashes: np.ndarray, lengths: list[int]) -> dict[int, int]:
    """How often each of the given shingles occurs in all documents; absent ones are left out."""
    known = docs.sparkSession.sparkContext.broadcast(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys(known.value)
        totals = np.zeros(len(keys.sorted), np.int64)
        for batch in batches:
            for _, data, offsets in words.slices(batch, "t"):
                own = Words(data, offsets)
                for n in lengths:
                    totals += np.bincount(keys.among(own.runs(n)[1])[1], minlength=len(totals))
        some = np.flatnonzero(totals)
        for at in range(0, len(some), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(some[at : at + 10_000]), pa.array(totals[some[at : at + 10_000]])], ["key", "n"])

    found = mapped(docs.select(F.col(f"`{text}`").alias("t")), count, "key long, n long")
    return {row.key: row.n for row in found.groupBy("key").agg(F.sum("n").alias("n")).collect()}  # at most the shingles of one block


@dataclass
class Index:
    """Windows by their prefix shingle."""

    keys: Keys
    lengths: list[int]
    #: Windows of key k: ``order[first[k]:first[k + 1]]``; ``place`` is the shingle's place in each.
    first: np.ndarray
    order: np.ndarray
    place: np.ndarray
    windows: Windows

    @classmethod
    def build(cls, windows: Windows, counts) -> Index:
        """``counts`` maps sorted distinct shingle hashes and their word counts to occurrences."""
        window, place, shingle_words, hashes = windows.pair
        distinct, number = np.unique(hashes, return_inverse=True)
        lengths = sorted(set(shingle_words.tolist()))
        seen = counts(distinct, lengths)
        often = np.zeros(len(distinct), np.int64)
        often[list(seen.keys())] = list(seen.values())
        order = np.lexsort((place, hashes, often[number], window))
        rarest = order[np.unique(window[order], return_index=True)[1]]
        keys, key = np.unique(hashes[rarest], return_inverse=True)
        by_key = np.argsort(key, kind="stable")
        first = np.searchsorted(key[by_key], np.arange(len(keys) + 1))
        return cls(Keys(keys), lengths, first, window[rarest][by_key], place[rarest][by_key], windows)

    def hits(self, own: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window in a text of the slice."""
        found_at, found_window = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        row_start = np.repeat(own.firsts[:-1], own.counts)
        for n in self.lengths:
            runs, hashes = own.runs(n)
            at, key = self.keys.among(hashes)
            each = self.first[key + 1] - self.first[key]
            entry = np.repeat(self.first[key], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            seen = np.repeat(runs[at], each)
            window = self.order[entry]
            start = seen - self.place[entry]
            fits = (start >= row_start[seen]) & (start + self.windows.length[window] <= own.row_end[seen])
            start, window = start[fits], window[fits]
            same = own.hashes(start, self.windows.length[window]) == self.windows.hash[window]
            found_at.append(start[same])
            found_window.append(window[same])
        at, window = np.concatenate(found_at), np.concatenate(found_window)
        text, length = self.windows.text, self.windows.length
        exact = np.array([own.text(a, a + length[w]) == text[w] for a, w in zip(at.tolist(), window.tolist())], bool)
        return at[exact], window[exact]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Rows (id, text) of the benchmark in blocks of bounded size."""
    rows = benchmark.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{text}`").alias("t"))
    size = rows.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)))).first()[0] or 0
    n = max(1, -(-2 * size // BLOCK_BYTES))
    if n == 1:
        yield [tuple(r) for r in rows.collect()]
        return
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``n_words``, ``hit_words`` and ``hit_items``.

    ``hit_words`` are the numbers of the words that lie inside an occurrence of a window, ascending;
    ``hit_items`` the ids of items with an occurring window, each once. Columns of these names are
    replaced. A null text has no words. A null item id counts for the hit words but is not listed; items
    that share an id count as one. Without items nothing is hit. Rows stay as they are, repeated ones too.
    """
    own_names = ["n_words", "hit_words", "hit_items"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in own_names]
    id_type = benchmark.schema[item_id].dataType
    source = beside(docs, kept, _source=F.col(f"`{text}`"))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("hit_words", T.ArrayType(T.IntegerType())), T.StructField("hit_items", T.ArrayType(id_type))]
    result = source.select("*", F.lit(None).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit_words"), F.array().cast(T.ArrayType(id_type)).alias("hit_items"))
    schema = T.StructType([*source.schema.fields, *fields])
    id_arrow = to_arrow_type(id_type)
    passes = 0
    for rows in _blocks(benchmark, item_id, item_text):
        windows = windows_of([t for _, t in rows], window_words, shingle_words)
        index = Index.build(windows, lambda h, n: shingle_counts(docs, text, h, n) if len(h) else {})
        sent = docs.sparkSession.sparkContext.broadcast((index, [i for i, _ in rows]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, ids = sent.value
            for batch in batches:
                for part, data, offsets in words.slices(batch, "_source"):
                    own = Words(data, offsets)
                    at, window = index.hits(own)
                    delta = np.zeros(len(own.starts) + 1, np.int64)
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + index.windows.length[window], -1)
                    hit = np.flatnonzero(np.cumsum(delta[:-1]) > 0)
                    row = np.searchsorted(own.firsts, at, "right") - 1
                    hit_row = np.searchsorted(own.firsts, hit, "right") - 1
                    items: dict[int, set] = {}
                    for r, w in zip(row.tolist(), window.tolist()):
                        items.setdefault(r, set()).add(ids[index.windows.item[w]])
                    words_hit = np.split(hit - own.firsts[hit_row], np.searchsorted(hit_row, np.arange(1, part.num_rows)))
                    earlier_words, earlier_items = part.column("hit_words").to_pylist(), part.column("hit_items").to_pylist()
                    hit_words = [sorted({*a, *b.tolist()}) if a else b for a, b in zip(earlier_words, words_hit)]
                    hit_items = [sorted({*b, *items.get(r, ())} - {None}) for r, b in enumerate(earlier_items)]
                    made = [pa.array(own.counts), pa.array(hit_words, pa.list_(pa.int32())), pa.array(hit_items, pa.list_(id_arrow))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-3], *made], part.schema.names)

        result = mapped(stage(result, "decontaminate") if passes else result, run, schema)
        passes += 1
    return named(result, kept, *own_names)


def decisions(marked: DataFrame) -> DataFrame:
    """Add ``n_hit`` and ``contaminated``: some word is hit, and one in 20 words at least."""
    n_hit = F.size("hit_words").cast("long")
    return marked.withColumns({"n_hit": n_hit, "contaminated": (n_hit > 0) & (20 * n_hit >= F.col("n_words"))})
