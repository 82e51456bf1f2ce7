"""Near-duplicate texts by SimHash and ball hashing.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Two
fingerprints link at ``radius`` or fewer differing bits. Such a pair has a common variant within half
the radius of both, so every fingerprint stands for all its variants within that distance, and
fingerprints that meet at a variant are linked.

The variants are not sent one by one: a fingerprint is sent once for each different leading part that
its variants have (37 times for 8 leading bits), and the task that receives a leading part makes the
rest of the variants itself, sorts them and links equal ones. The number of leading bits follows the
number of fingerprints, so the variants that one task makes at a time stay bounded; it has no part in
the result.

All fingerprints that meet at one variant are within the radius of each other, hence a chain through
them keeps every class whole without naming all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm import words
from shopfloor.llm.ship import mapped
from shopfloor.session import stage

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Variants that a task makes and sorts at a time.
VARIANTS_AT_ONCE = 1 << 20
#: Leading bits at least, and variants that a leading part should stand for at most.
LEAST_BITS, VARIANTS_A_PART = 8, 1 << 22


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes, the bits that over half of them have set; 0 for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        firsts = (np.cumsum(counts) - counts)[full]
        votes = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        set_bits = np.packbits(votes * 2 > counts[full, None], axis=1, bitorder="little")
        out[full] = set_bits.view("<u8").ravel()
    return out


def simhashes(data: np.ndarray, offsets: np.ndarray, shingle_words: int) -> np.ndarray:
    """Fingerprints of the texts of one slice."""
    data = words.LOWER[data]
    starts, ends, firsts = words.find(data, offsets, words.SOLID)
    text, starts, ends = words.single_spaced(data, offsets, starts, ends)
    n = np.diff(firsts)
    counts = np.where(n == 0, 0, np.maximum(n - shingle_words + 1, 1))
    head = np.repeat(firsts[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    tail = np.minimum(head + shingle_words, np.repeat(firsts[1:], counts)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(starts[head].tolist(), ends[tail].tolist())]
    return _majority(np.array(hashes, np.uint64), counts)


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The columns ``keep`` (all by default) and ``_fingerprint``, a long whose bits are the fingerprint.

    A null text counts as empty; a text without words has fingerprint zero.
    """
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    source = docs.select(*kept, F.col(f"`{text}`").alias("_source_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("_fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "_source_text"):
                found = pa.array(simhashes(data, offsets, shingle_words).view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], [*part.schema.names[:-1], "_fingerprint"])

    return mapped(source, run, schema)


@lru_cache(maxsize=512)
def _masks(bits: int, flips: int) -> np.ndarray:
    """All values with at most ``flips`` of the lowest ``bits`` bits set."""
    return np.array([sum(1 << i for i in chosen) for k in range(flips + 1) for chosen in combinations(range(bits), k)], np.uint64)


class _Forest:
    """Links of a task without those that others already imply."""

    def __init__(self):
        self._up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        up = self._up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def link(self, a: int, b: int) -> None:
        x, y = self._root(a), self._root(b)
        if x != y:
            self._up[max(x, y)] = min(x, y)
            self.links.append((a, b))


def _meet(prints: np.ndarray, left: np.ndarray, bits: int, forest: _Forest) -> None:
    """Link the fingerprints that have a common variant.

    ``prints`` agree in all but the lowest ``bits`` bits once the flips they have spent are made;
    ``left`` are the flips each has left for the lowest bits.
    """
    masks = {k: _masks(bits, k) for k in np.unique(left).tolist()} if bits < 64 else {}
    size = sum(int((left == k).sum()) * len(m) for k, m in masks.items())
    if (size > VARIANTS_AT_ONCE or not masks) and bits > 8:
        step = min(4, bits)
        heads = prints >> np.uint64(bits - step) & np.uint64((1 << step) - 1)
        for value in range(1 << step):
            spent = np.bitwise_count(heads ^ np.uint64(value)).astype(np.int64)
            near = spent <= left
            if near.sum() > 1:
                _meet(prints[near], left[near] - spent[near], bits - step, forest)
        return
    low = np.uint64((1 << bits) - 1)
    variants = np.concatenate([((prints[left == k] & low)[:, None] ^ m[None, :]).ravel() for k, m in masks.items()])
    ordered = np.sort(variants)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    owners = np.concatenate([np.repeat(prints[left == k], len(m)) for k, m in masks.items()])
    maybe = np.zeros(1 << 16, bool)
    maybe[words.mix(twice) & np.uint64(0xFFFF)] = True
    at = np.flatnonzero(maybe[words.mix(variants) & np.uint64(0xFFFF)])
    at = at[np.isin(variants[at], twice)]
    order = at[np.lexsort((owners[at], variants[at]))]
    same = variants[order][1:] == variants[order][:-1]
    links = np.unique(np.stack([owners[order][:-1][same], owners[order][1:][same]], 1), axis=0)
    for a, b in links.tolist():
        forest.link(a, b)


def leading_bits(n: int, radius: int = RADIUS) -> int:
    """Leading bits to deal variants out by, for n fingerprints."""
    bits = LEAST_BITS
    variants = sum(math.comb(64, k) for k in range(radius // 2 + 1))
    while n * variants > VARIANTS_A_PART << bits and bits < 40:
        bits += 1
    return bits


def links(prints: DataFrame, column: str = "_fingerprint", radius: int = RADIUS) -> DataFrame:
    """Links (``a``, ``b``) between different values of ``column`` that join the same classes as all links within ``radius``.

    ``prints`` must hold each fingerprint once. ``radius`` is even: both ends flip half of it.
    """
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even, since either side takes half of it")
    half, bits = radius // 2, leading_bits(prints.count(), radius)
    masks = _masks(bits, half) << np.uint64(64 - bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                parts = (own[:, None] ^ masks[None, :]) >> np.uint64(64 - bits)
                yield pa.RecordBatch.from_arrays([pa.array(parts.ravel().view(np.int64)), pa.array(np.repeat(own, len(masks)).view(np.int64))], ["part", "own"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        own = group["own"].to_numpy().view(np.uint64)
        part = np.uint64(group["part"].iloc[0])
        spent = np.bitwise_count((own >> np.uint64(64 - bits)) ^ part).astype(np.int64)
        forest = _Forest()
        _meet(own, half - spent, 64 - bits, forest)
        pairs = np.array(forest.links, np.uint64).reshape(-1, 2)
        pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= radius].view(np.int64)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return (
        mapped(prints.select(F.col(f"`{column}`").alias("own")), deal, "part long, own long")
        .groupBy("part")
        .applyInPandas(join, "a long, b long")
        .distinct()
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest node (``root``) that each ``node`` of the edges (``a``, ``b``) can reach.

    Alternates two steps that hang nodes on the smallest neighbour, until nothing changes. Each step
    is a minimum by node and a join; its edges are staged, so lineage stays short.
    """
    # On edges (u, v) with u > v. A step's edges join the same nodes as before.
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = stage(both.groupBy("x").agg(F.least("x", F.min("y")).alias("m")), "least")
        large = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u")
        edges = stage(
            moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _with_classes(prints: DataFrame, radius: int) -> DataFrame:
    """For each fingerprint of ``prints`` (``_fingerprint``, ``_id``, ``_row``): ``component_id``, and ``_kept``, the row of the class's smallest id."""
    first = F.struct(F.col("_id").isNull().alias("unknown"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    classes = stage(prints.groupBy("_fingerprint").agg(F.min(first).alias("_first")), "classes")
    found = components(stage(links(classes.select("_fingerprint"), radius=radius), "links"))
    known = classes.join(stage(found, "components").withColumnRenamed("node", "_fingerprint"), "_fingerprint", "left")
    known = known.withColumn("root", F.coalesce("root", "_fingerprint"))
    smallest = known.groupBy("root").agg(F.min("_first").alias("least"))
    picked = known.join(smallest, "root").select("_fingerprint", F.col("least.id").alias("component_id"), F.col("least.row").alias("_kept"))
    return stage(picked, "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id among the rows that can be reached over links; it is null only
    if all their ids are null. Equal rows stay separate rows of one class. Empty and null texts share
    fingerprint zero and so one class. No rows give no rows.
    """
    ids = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(f"`{text}`").alias("_text"))
    prints = stage(fingerprints(ids, "_text", ["_id", "_row"], shingle_words), "fingerprints")
    return prints.join(_with_classes(prints, radius), "_fingerprint").select(
        F.col("_id").alias(doc_id), F.lpad(F.lower(F.hex("_fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the smallest id; of repeated ids one row.

    All columns stay as they are, whatever their names. Null, empty and blank texts are one class (fingerprint
    zero); of a class without any id one row stays. No rows give no rows.
    """
    # The columns go under plain names, so that none can clash with those made here.
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*own, F.col(f"`{doc_id}`").alias("_id"), F.monotonically_increasing_id().alias("_row"))
    prints = stage(fingerprints(rows, f"c{docs.columns.index(text)}", None, shingle_words), "fingerprints")
    classes = _with_classes(prints.select("_fingerprint", "_id", "_row"), radius)
    surplus = prints.select("_fingerprint", "_row").join(classes, "_fingerprint").where("_row <> _kept").select("_row")
    return prints.join(stage(surplus, "surplus"), "_row", "left_anti").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
