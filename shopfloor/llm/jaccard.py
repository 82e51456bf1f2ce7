"""All pairs of texts whose sets of word shingles are alike, as classes: an exact Jaccard join by pigeonhole.

A set's size tells its band; sizes that can be alike lie in one band or in two that touch. Each band cuts the
universe of shingles into segments by a hash, one segment more than the shingles in which an alike pair can
differ (and one to spare). So an alike pair agrees wholly in two segments at least, and in one that is not
empty if either set has at most one empty segment; such sets leave out their empty segments, which would meet
with those of all others. The signature of a segment is a hash of the set's shingles in it.

Where that leaves too much to compare, half as many segments do: if each is also indexed with any one of its
shingles left out, an alike pair meets in one of them at least. Which of both a band gets is told by cost: the
comparisons that its exact segments have left over, as measured, against the rows of the one-deletion
neighbourhoods of the sets left over.

Sets that meet at a signature are compared in two steps. First each with one set of the bucket, the one that
shares most signatures with others; what is verified there joins classes. Then, in buckets that still hold
several classes, the members outside the largest class are compared with all of other classes, block by block:
a pair is sent on only if bitmaps of both sets (each shingle flips one bit) differ in few enough bits. All
links are verified by the exact coefficient. So no link between two classes is missed, and a bucket of one
large class costs one comparison for each member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.near_dedup import components
from shopfloor.llm.ship import mapped
from shopfloor.operators.joins import small
from shopfloor.session import stage

SHINGLE_WORDS = 3
PERCENT = 90
#: Words of 64 bits of a set's bitmap.
BITMAP_WORDS = 16
#: Bits of the filter that spares most sets no one asks for; what passes is joined exactly.
FILTER_BITS = 24
#: Members of a bucket that one task holds of either side at a time, and comparisons it makes at a time.
BLOCK, COMPARED = 2048, 1 << 16
#: Sets that a task remembers, so as to send equal ones once.
MET = 1 << 18
#: Comparisons that cost as much as a row of an index.
CHEAPER = 100
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def most_apart(sizes: int, percent: int = PERCENT) -> int:
    """In how many elements two alike sets can differ whose sizes add up to ``sizes``."""
    return sizes * (100 - percent) // (100 + percent)


def band_starts(most: int, percent: int = PERCENT) -> np.ndarray:
    """The least size of each band, up to one beyond ``most``; two bands on, no set can be alike."""
    starts = [1]
    while starts[-1] <= max(most, 1):
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array([*starts, starts[-1] * 100 // percent + 1], np.int64)


def home_bands(counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The band of each size; 0 for none."""
    return np.maximum(np.searchsorted(band_starts(int(counts.max(initial=0)), percent), counts, "right") - 1, 0)


def sets_of(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles (hashes) of each text of a slice, and how many each text has; a shorter text is one shingle."""
    data = words.LOWER[data]
    starts, ends, firsts = words.find(data, offsets, words.SOLID)
    text, starts, ends = words.single_spaced(data, offsets, starts, ends)
    n = np.diff(firsts)
    counts = np.where(n == 0, 0, np.maximum(n - shingle_words + 1, 1))
    row = np.repeat(np.arange(len(counts)), counts)
    head = np.repeat(firsts[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    tail = np.minimum(head + shingle_words, np.repeat(firsts[1:], counts)) - 1
    hashes = words.Hasher.of_bytes(np.frombuffer(text, np.uint8))(starts[head], ends[tail])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(counts))


def _sums(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Sums modulo 2^64 of ``values`` by ``at``."""
    order = np.argsort(at, kind="stable")
    where, first = np.unique(at[order], return_index=True)
    out = np.zeros(size, np.uint64)
    if len(where):
        out[where] = np.add.reduceat(values[order], first)
    return out


def digests(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    total = _sums(words.mix(hashes), np.repeat(np.arange(len(counts)), counts), len(counts))
    return words.mix(total + counts.astype(np.uint64) * _GOLDEN)


def bitmaps(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each set bits that its elements flip; two sets differ in no fewer elements than bits."""
    bits = BITMAP_WORDS * 64
    row = np.repeat(np.arange(len(counts)), counts)
    at = (words.mix(hashes ^ _GOLDEN) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(row * bits + at, minlength=len(counts) * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(counts), bits), axis=1, bitorder="little")


def signatures(hashes: np.ndarray, counts: np.ndarray, near: frozenset[int] | None = None, percent: int = PERCENT) -> tuple[np.ndarray, ...]:
    """(signature, number of the set) of the sets of a slice: for the band of a set, and as the smaller one for the next.

    With ``near``, only for bands in it, and by one-deletion neighbourhoods; else for all bands by exact
    segments. Bands in which alike sets are equal have none. The last eight bits of a signature are its band.
    """
    starts = band_starts(int(counts.max(initial=0)), percent)
    home = home_bands(counts, percent)
    row = np.repeat(np.arange(len(counts)), counts)
    mixed = words.mix(hashes)
    found = []
    for up in (0, 1):
        band = home + up
        apart = most_apart(2 * (starts[band + 1] - 1), percent)
        wanted = (counts > 0) & (apart > 0)
        if near is not None:
            wanted &= np.isin(band, list(near))
        segments = np.where(wanted, apart // 2 + 1 if near is not None else apart + 2, 0)
        first = np.cumsum(segments) - segments  # cells: one for each set and segment
        use = wanted[row]
        own, token = row[use], mixed[use]
        salt = words.mix(band.astype(np.uint64) * _GOLDEN + np.uint64(1))
        part = (words.mix(token ^ salt[own]) % np.maximum(segments, 1).astype(np.uint64)[own]).astype(np.int64)
        cell = first[own] + part
        n_cells = int(segments.sum())
        total, n = _sums(token, cell, n_cells), np.bincount(cell, minlength=n_cells)
        of = np.repeat(np.arange(len(counts)), segments)
        name = words.mix(salt[of] + (np.arange(n_cells) - first[of]).astype(np.uint64) * _GOLDEN)
        sealed = lambda total, n, name: words.mix(name ^ words.mix(total + n.astype(np.uint64) * _GOLDEN))
        if near is None:
            empty = np.bincount(of[n == 0], minlength=len(counts))
            sent = (n > 0) | (empty[of] > 1)
            sig, of = sealed(total, n, name)[sent], of[sent]
        else:
            less = sealed(total[cell] - token, n[cell] - 1, name[cell])
            sig, of = np.concatenate([sealed(total, n, name), less]), np.concatenate([of, own])
        found.append((sig & ~np.uint64(255) | band[of].astype(np.uint64) & np.uint64(255), of))
    return tuple(np.concatenate(c) for c in zip(*found))


def _each_set(docs: DataFrame, text: str, schema, make, shingle_words: int) -> DataFrame:
    """What ``make(part, hashes, counts, nodes, new)`` yields for each slice; ``new`` are the sets that the task has not met yet, about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(0, np.uint64)
        for batch in batches:
            for part, data, offsets in words.slices(batch, text):
                hashes, counts = sets_of(data, offsets, shingle_words)
                nodes = digests(hashes, counts)
                new = np.zeros(len(counts), bool)
                new[np.unique(nodes, return_index=True)[1]] = True
                new &= (counts > 0) & ~np.isin(nodes, met)
                met = np.concatenate([met if len(met) < MET else met[:0], nodes[new]])
                yield from make(part, hashes, counts, nodes, new)

    return mapped(docs, run, schema)


def _listed(of: np.ndarray, values: np.ndarray, rows: int) -> pa.ListArray:
    """Lists of the ``values`` of each row."""
    order = np.argsort(of, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order].view(np.int64)))


def _signed(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(``_id``, ``node``, ``n``, ``sigs``) of every row of ``docs`` (``_id``, ``_text``); a task lists the signatures of equal sets about once."""
    schema = T.StructType([docs.schema.fields[0], T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sigs", T.ArrayType(T.LongType()))])

    def make(part, hashes, counts, nodes, new):
        sig, of = signatures(hashes[np.repeat(new, counts)], np.where(new, counts, 0), None, percent)
        columns = [part.column("_id"), pa.array(nodes.view(np.int64)), pa.array(counts.astype(np.int64)), _listed(of, sig, len(counts))]
        yield pa.RecordBatch.from_arrays(columns, schema.names)

    return _each_set(docs, "_text", schema, make, shingle_words)


def _neighbourhoods(docs: DataFrame, nodes: DataFrame, bands: frozenset[int], shingle_words: int, percent: int) -> DataFrame:
    """(``sig``, ``node``) of the one-deletion neighbourhoods of these sets in these bands."""
    asked = _filter_of(nodes, "node")

    def make(part, hashes, counts, own, new):
        new = new & _passes(asked, own)
        sig, of = signatures(hashes[np.repeat(new, counts)], np.where(new, counts, 0), bands, percent)
        for at in range(0, len(sig), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(sig[at : at + 200_000].view(np.int64)), pa.array(own[of[at : at + 200_000]].view(np.int64))], ["sig", "node"])

    return _each_set(docs, "_text", "sig long, node long", make, shingle_words).join(small(nodes), "node", "left_semi")


def _bits_of(values: DataFrame, column: str) -> DataFrame:
    """(``_word``, ``_bits``): a filter of fixed size that holds for all of ``column``; tasks join its words of 64 bits."""
    low = F.col(column).bitwiseAND(F.lit(((1 << FILTER_BITS) - 1) << 8))
    bits = values.select(F.shiftright(low, 14).alias("_word"), F.expr(f"shiftleft(1L, cast(shiftright({column}, 8) & 63 AS int))").alias("_bit"))
    return bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def _filter_of(values: DataFrame, column: str) -> np.ndarray:
    out = np.zeros((1 << FILTER_BITS) // 64, np.uint64)
    for r in _bits_of(values, column).toLocalIterator():
        out[r["_word"]] = np.int64(r["_bits"]).view(np.uint64)
    return out


def _passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values >> np.uint64(8) & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _wanted_sets(docs: DataFrame, nodes: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """(``node``, ``n``, ``home``, ``tokens``, ``bits``) of the sets whose ``node`` the frame ``nodes`` has, each once."""
    asked = _filter_of(nodes, "node")

    def make(part, hashes, counts, own, new):
        pick = np.flatnonzero(new & _passes(asked, own))
        if not len(pick):
            return
        held, n = hashes[np.isin(np.repeat(np.arange(len(counts)), counts), pick)], counts[pick]
        columns = [own[pick].view(np.int64), n.astype(np.int64), home_bands(n, percent)]
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(held.view(np.int64)))
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), tokens, pa.array([b.tobytes() for b in bitmaps(held, n)], pa.binary())], ["node", "n", "home", "tokens", "bits"])

    sent = _each_set(docs, "_text", "node long, n long, home long, tokens array<long>, bits binary", make, shingle_words)
    # Equal sets of several tasks: one of them stays.
    return sent.join(small(nodes), "node", "left_semi").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) that are alike."""
    own = sets.select("node", "tokens")
    both = pairs.join(own.toDF("a", "_a"), "a").join(own.toDF("b", "_b"), "b")
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    return both.where(100 * common >= percent * (F.size("_a") + F.size("_b") - common)).select("a", "b")


def _alike_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b).cast("long") >= percent * F.greatest(a, b).cast("long")


def _open_members(signed: DataFrame) -> DataFrame:
    """The rows (``sig``, ``node``) whose signature several sets share, each once.

    Most signatures are of one set. So the shared ones are found by a sum, and a filter of them spares the
    other rows the shuffle.
    """
    shared = signed.groupBy("sig").agg(F.min("node").alias("_least"), F.max("node").alias("_most")).where("_least <> _most").select("sig")
    shared = stage(shared, "jaccard-shared")
    # At most 2^18 rows, whatever the number of signatures.
    maybe = F.broadcast(_bits_of(shared, "sig"))
    low = F.col("sig").bitwiseAND(F.lit(((1 << FILTER_BITS) - 1) << 8))
    kept = signed.join(maybe, (F.shiftright(low, 14) == F.col("_word")) & (F.expr("shiftright(_bits, cast(shiftright(sig, 8) & 63 AS int)) & 1L") != 0)).select("sig", "node")
    return kept.join(small(shared), "sig", "left_semi").distinct()


def _described(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with their ``n``, and ``own``: whether their bucket is of their own band. Buckets of the band below alone are left out."""
    told = members.join(small(sets.select("node", "n", "home")), "node").withColumn("band", F.col("sig").bitwiseAND(F.lit(255)))
    return told.withColumn("own", F.col("home").bitwiseAND(F.lit(255)) == F.col("band")).drop("home")


def _leaders(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each member with the set of its bucket that shares most signatures."""
    sizes = members.groupBy("sig").agg(F.count("*").alias("_size"))
    degree = members.join(sizes, "sig").groupBy("node").agg(F.sum("_size").alias("_degree"))
    ranked = members.join(degree, "node")
    leader = ranked.groupBy("sig").agg(F.max(F.struct("own", "_degree", "node", "n")).alias("_lead"))
    pairs = members.join(leader, "sig").where(F.col("_lead.own") & (F.col("node") != F.col("_lead.node")) & _alike_sizes("n", "_lead.n", percent))
    return pairs.select(F.least("node", "_lead.node").alias("a"), F.greatest("node", "_lead.node").alias("b")).distinct()


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with their ``root``, and what the bucket has of its largest class (``_main``) and besides (``_rest``)."""
    known = members.join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = known.groupBy("sig", "root").agg(F.count("*").alias("_n"), F.bool_or("own").alias("_own"))
    mixed = by_root.groupBy("sig").agg(F.max(F.struct("_n", "root")).alias("_top"), F.sum("_n").alias("_all"), F.count("*").alias("_roots"), F.bool_or("_own").alias("_own")).where("_roots > 1 AND _own")
    told = mixed.select("sig", F.col("_top.root").alias("_main_root"), F.col("_top._n").alias("_main"), (F.col("_all") - F.col("_top._n")).alias("_rest"))
    return known.join(told, "sig")


def _across(unsettled: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs (``a``, ``b``) of different classes of a bucket that their sizes and bitmaps allow.

    The members outside the bucket's largest class are one side, cut into blocks; they meet blocks of the
    largest class, and blocks of their own from theirs on. A task holds one block of either side.
    """
    blocks = lambda n: F.ceil(F.col(n) / F.lit(block)).cast("long")
    in_main = F.col("root") == F.col("_main_root")
    dealt = unsettled.select(
        "sig", "node", "n", "root", "own", in_main.alias("_in_main"), blocks("_main").alias("_mains"), blocks("_rest").alias("_rests"),
        F.pmod(F.xxhash64("node"), F.when(in_main, blocks("_main")).otherwise(blocks("_rest"))).alias("_block"),
    )
    rest = dealt.where("NOT _in_main")
    asks = rest.select("sig", F.col("_block").alias("i"), F.explode(F.concat(F.sequence(F.lit(0), F.col("_mains") - 1), F.sequence(F.col("_mains") + F.col("_block"), F.col("_mains") + F.col("_rests") - 1))).alias("j"), F.lit(True).alias("asks"), "node", "n", "root", "own")
    of_main = dealt.where("_in_main").select("sig", F.explode(F.sequence(F.lit(0), F.col("_rests") - 1)).alias("i"), F.col("_block").alias("j"), F.lit(False).alias("asks"), "node", "n", "root", "own")
    of_rest = rest.select("sig", F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("i"), (F.col("_mains") + F.col("_block")).alias("j"), F.lit(False).alias("asks"), "node", "n", "root", "own")
    rows = asks.unionByName(of_main).unionByName(of_rest).join(sets.select("node", "bits"), "node")

    def compared(rows: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        """Pairs of whole groups: each asking row with all others of its group, some comparisons at a time."""
        group = np.cumsum(np.append(True, (np.diff(rows[["sig", "i", "j"]].to_numpy(), axis=0) != 0).any(axis=1))) - 1
        asks = rows["asks"].to_numpy()
        bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(-1, BITMAP_WORDS)
        node, n, root, own = (rows[c].to_numpy() for c in ("node", "n", "root", "own"))
        ask, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        first, last = (np.searchsorted(group[other], group[ask], side) for side in ("left", "right"))
        before = np.cumsum(last - first)
        found, at = [], 0
        while at < len(ask):
            to = max(at + 1, int(np.searchsorted(before, (before[at - 1] if at else 0) + COMPARED, "right")))
            each = (last - first)[at:to]
            a = np.repeat(ask[at:to], each)
            b = other[np.repeat(first[at:to], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)]
            least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            maybe = (root[a] != root[b]) & (own[a] | own[b]) & (100 * least >= percent * most)
            a, b = a[maybe], b[maybe]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            near = apart <= (n[a] + n[b]) * (100 - percent) // (100 + percent)
            found.append(np.stack([np.minimum(node[a[near]], node[b[near]]), np.maximum(node[a[near]], node[b[near]])], 1))
            at = to
        if found:
            a, b = np.unique(np.concatenate(found), axis=0).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups are runs of sorted rows: the last run of a batch waits for the next batch."""
        held = []
        for batch in batches:
            frame = batch.to_pandas()
            key = frame[["sig", "i", "j"]].to_numpy()
            if not len(frame):
                continue
            if held and (held[-1][["sig", "i", "j"]].to_numpy()[-1] != key[0]).any():
                yield from compared(pd.concat(held))
                held = []
            cut = int((np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).max(initial=0))
            if cut:
                yield from compared(pd.concat([*held, frame.iloc[:cut]]))
                held = []
            held.append(frame.iloc[cut:])
        if held:
            yield from compared(pd.concat(held))

    ordered = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return mapped(ordered.select("sig", "i", "j", "asks", "node", "n", "root", "own", "bits"), of_runs, "a long, b long").distinct()


def classes(docs: DataFrame, signed: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(``node``, ``root``) of all sets of ``docs`` that are linked with another: equal ``root``, one class."""
    open_ = stage(_open_members(signed.select(F.explode("sigs").alias("sig"), "node")), "jaccard-open")
    asked = stage(open_.select("node").distinct(), "jaccard-asked")
    sets = stage(_wanted_sets(docs, asked, shingle_words, percent), "jaccard-sets")
    members = stage(_described(open_, sets), "jaccard-members")
    links = stage(_verified(_leaders(members, percent), sets, percent), "jaccard-links")
    roots = stage(components(links), "jaccard-roots")
    unsettled = stage(_unsettled(members, roots), "jaccard-unsettled")

    # By band: the comparisons left over, against the rows of neighbourhoods of the sets left over.
    left = unsettled.groupBy("band").agg(F.sum(F.when(F.col("root") != F.col("_main_root"), F.col("_main") + F.col("_rest")).cast("double")).alias("left"))
    rows = unsettled.groupBy("band", "node").agg(F.max("n").alias("n")).groupBy("band").agg(F.sum(F.col("n").cast("double")).alias("rows"))
    costly = frozenset(r.band for r in left.join(rows, "band").where(F.col("left") > CHEAPER * F.col("rows")).select("band").collect())
    if costly:
        # A link that is left over joins two sets that are left over in one band.
        again = stage(unsettled.where(F.col("band").isin(*costly)).select("node").distinct(), "jaccard-again")
        near = stage(_neighbourhoods(docs, again, costly, shingle_words, percent), "jaccard-near")
        members = stage(_described(_open_members(near), sets), "jaccard-members")
        unsettled = unsettled.where(~F.col("band").isin(*costly)).unionByName(_unsettled(members, roots))
    pairs = _across(unsettled, sets, percent, block)
    more = stage(_verified(pairs, sets, percent), "jaccard-links")
    return components(links.unionByName(more))


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``.

    Two rows are linked if 100 times the shingles they share are at least ``percent`` times those that either
    has; a text shorter than a shingle is one shingle. ``component_id`` is the smallest id that links reach,
    null only if all their ids are null. Null, empty and blank texts have no shingle and no link: each such row
    is its own class. Repeated rows stay apart, in one class. No rows give no rows. Shingles and whole sets are
    told apart by hashes of 64 bits. Columns other than the id and the text are not read.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    signed = stage(_signed(own, shingle_words, percent), "jaccard-signed")
    rows = signed.select("_id", "node", "n")
    roots = stage(classes(own, signed, shingle_words, percent, block), "jaccard-classes")
    by_node = rows.where("n > 0").groupBy("node").agg(F.min("_id").alias("_least"))
    by_node = by_node.join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = by_node.groupBy("root").agg(F.min("_least").alias("_first"))
    named = stage(by_node.join(least, "root").select("node", F.col("_first").alias("component_id")), "jaccard-named")
    full = rows.where("n > 0").join(small(named), "node").select(F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select(F.col("_id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("_id").alias("component_id"))
    return full.unionByName(none)
