"""Shards of nearly equal bytes: a minimax contiguous partition of atomic groups.

Rows with equal texts form a group, which is never cut. Groups stand in the order of a digest of their
text, so shards come out mixed. The smallest capacity with which ``n_shards`` contiguous shards hold
all groups is found by binary search; a capacity is checked greedily: each shard takes groups as long
as they fit.

The search never sees all groups. Running sums of bytes are staged once, in order. A summary of at
most ``SUMMARY_BLOCKS`` blocks of the sums (least, greatest and number of group ends in each) gives a
lower and an upper bound of every greedy cut. Where these disagree about a capacity, one further job
makes finer blocks just around those cuts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor.llm.ship import mapped
from shopfloor.session import stage

#: Blocks in a summary of the group ends at most; each is three numbers on the driver.
SUMMARY_BLOCKS = 1 << 14


class GroupEnds:
    """Bounds on "the last group end that is at most t", refined on demand.

    ``ends`` has the column ``sum``: the running sums at which groups end.
    """

    def __init__(self, ends: DataFrame, total: int, blocks: int = SUMMARY_BLOCKS):
        self._ends, self._most = ends, blocks
        self._blocks = self._summary([(0, total)])

    def _summary(self, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(least, greatest, number) of the ends in each block of the ranges (first exclusive, last inclusive)."""
        width = max(1, -(-sum(b - a for a, b in ranges) // self._most))
        sums = F.col("sum")
        which = F.coalesce(*[F.when((sums > a) & (sums <= b), F.lit(i)) for i, (a, b) in enumerate(ranges)])
        found = self._ends.where(reduce(or_, [(sums > a) & (sums <= b) for a, b in ranges]))
        blocks = found.groupBy(which.alias("r"), F.floor(sums / width).alias("k")).agg(F.min("sum"), F.max("sum"), F.count("*")).collect()
        return sorted(tuple(row[2:]) for row in blocks)

    def bounds(self, t: int) -> tuple[int, int]:
        """The last end at or before ``t`` lies between these two."""
        i = bisect_right(self._blocks, t, key=lambda block: block[0]) - 1
        if i < 0:
            return 0, 0
        least, greatest, n = self._blocks[i]
        if t >= greatest:
            return greatest, greatest
        return least, least if n <= 2 else t

    def refine(self, spans: list[tuple[int, int]]) -> None:
        """Make finer blocks of those that meet the spans."""
        ranges: list[tuple[int, int]] = []
        for low, high in spans:
            met = [b for b in self._blocks if b[0] <= high and b[1] >= low]
            low, high = met[0][0] - 1, met[-1][1]
            if ranges and low < ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(high, ranges[-1][1]))
            else:
                ranges.append((low, high))
        finer = self._summary(ranges)
        if all(b in self._blocks for b in finer):
            self._most *= 2  # the blocks were as fine already
        self._blocks = sorted([b for b in self._blocks if not any(low < b[0] <= high for low, high in ranges)] + finer)


def _greedy(capacity: int, total: int, n_shards: int, step) -> list[int]:
    """Where shards end if each takes what ``step`` says fits."""
    cuts, at = [], 0
    for _ in range(n_shards):
        at = step(min(at + capacity, total))
        cuts.append(at)
    return cuts


def smallest_capacity(ends: GroupEnds, total: int, n_shards: int) -> tuple[int, list[int]]:
    """The least feasible capacity and the greedy cuts with it."""
    low, high = -(-total // n_shards) - 1, total  # low is too small, high is enough
    while True:
        capacity = (low + high) // 2 if high - low > 1 else high
        sure = _greedy(capacity, total, n_shards, lambda t: ends.bounds(t)[0])
        hoped = _greedy(capacity, total, n_shards, lambda t: ends.bounds(t)[1])
        if high - low > 1 and sure[-1] >= total:
            high = capacity
        elif high - low > 1 and hoped[-1] < total:
            low = capacity
        elif sure == hoped:
            return high, sure
        else:
            ends.refine([(a, b) for a, b in zip(sure, hoped) if a < b])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running bytes and rows within the slice, and the slice's number."""
    number = TaskContext.get().partitionId()
    total = rows = 0
    for batch in batches:
        sums = total + np.cumsum(batch.column("_size").to_numpy())
        places = rows + np.arange(1, batch.num_rows + 1)
        total, rows = (int(sums[-1]), int(places[-1])) if batch.num_rows else (total, rows)
        added = [pa.array(sums), pa.array(places), pa.array(np.full(batch.num_rows, number, np.int32))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_in_slice", "_place", "_slice"])


def shards(docs: DataFrame, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    The size is the text's UTF-8 bytes plus 1. Equal texts share a shard; null texts are one group, apart
    from empty ones. Slots count from 0 in each shard, without gaps. Shards may stay empty if there are
    fewer groups than shards. Rows that are equal in id and text are told apart by their slots only.
    """
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("_size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("_crc"),
        F.coalesce(F.unhex(F.sha2(body, 256)), F.lit(b"")).alias("_group"),
    )
    # One shuffle, of narrow rows. A group of any size may lie over several slices.
    ordered = narrow.repartitionByRange("_group", "_id").sortWithinPartitions("_group", "_id")
    added = [T.StructField("_in_slice", T.LongType()), T.StructField("_place", T.LongType()), T.StructField("_slice", T.IntegerType())]
    schema = T.StructType([*ordered.schema.fields, *added])
    rows = stage(mapped(ordered, _running, schema), "shard-rows")
    # One row for each slice, so as many as tasks.
    slices = rows.groupBy("_slice").agg(F.max("_in_slice"), F.max("_place")).orderBy("_slice").collect()
    offsets, total, count = [], 0, 0
    for number, size, n in slices:
        offsets.append((number, total, count))
        total, count = total + size, count + n
    before = spark.createDataFrame(offsets or [(0, 0, 0)], "_slice int, _sum_before long, _rows_before long")
    rows = rows.join(F.broadcast(before), "_slice").select(
        "_id", "_size", "_crc", "_group", (F.col("_in_slice") + F.col("_sum_before")).alias("_sum"), (F.col("_place") + F.col("_rows_before")).alias("_row")
    )
    ends = rows.groupBy("_group").agg(F.max("_sum").alias("sum")).select("sum")
    ends = stage(ends.repartitionByRange("sum").sortWithinPartitions("sum"), "shard-ends")
    cuts = smallest_capacity(GroupEnds(ends, total), total, n_shards)[1][:-1] if total else []
    inner = _rows_at(rows, cuts)
    shard, first = F.lit(0), F.lit(0).cast("long")
    for number, (cut, at) in enumerate(zip(cuts, inner), 1):
        shard = F.when(F.col("_sum") > cut, number).otherwise(shard)
        first = F.when(F.col("_sum") > cut, F.lit(at).cast("long")).otherwise(first)
    return rows.select(
        F.col("_id").alias(doc_id),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        shard.cast("int").alias("shard"),
        (F.col("_row") - 1 - first).alias("slot"),
    )


def _rows_at(rows: DataFrame, cuts: list[int]) -> list[int]:
    """How many rows lie at or before each cut."""
    if not cuts:
        return []
    return [n or 0 for n in rows.agg(*[F.sum(F.when(F.col("_sum") <= c, 1).otherwise(0)) for c in cuts]).first()]
