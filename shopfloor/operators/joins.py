"""Joins of a large fact table with a lookup table that may be small or large."""

from __future__ import annotations

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1 / 500
# Beyond so many rows a key is hot, however small its share; the keys listed for it are the largest.
HOT_ROWS = 50_000_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes a row takes when it is broadcast: eight for each column, and the length of texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields if not isinstance(f.dataType, NumericType)]
    return reduce(add, texts, F.lit(8 * (len(df.columns) + 1)))


def fits(df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``df`` may be broadcast: its rows and its bytes are counted in one pass."""
    n, size = df.agg(F.count("*"), F.sum(row_bytes(df))).first()
    return n <= (BROADCAST_ROWS if rows is None else rows) and (size or 0) <= BROADCAST_BYTES


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it fits."""
    return F.broadcast(df) if fits(df) else df


def heavy_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Key values that hold more than ``share`` of all rows or more than ``HOT_ROWS``; at most ``1 / share`` of them.

    That bound is what allows the list to be broadcast. Rows are counted with map-side aggregation, in one
    pass, so a hot key costs one partial count per task.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    hot = (F.col("_rows") > total * share) | (F.col("_rows") > HOT_ROWS)
    found = counts.filter(hot).orderBy(F.desc("_rows")).limit(int(1 / share)).select(*keys)
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Column | None = None,
    null_safe: bool = False,
    broadcast_rows: int | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """Inner or left join ``fact`` to ``lookup``, whichever size the lookup and whichever skew the fact has.

    * The lookup is measured; up to ``broadcast_rows`` rows (``BROADCAST_ROWS`` unless given) and
      ``BROADCAST_BYTES`` it is broadcast and the fact does not move.
    * Beyond that, fact rows of heavy keys (and of NULL keys) are joined to just their lookup rows,
      which are broadcast after a second count; all other rows take a shuffled join.

    ``residual`` may refer to columns of either side; the lookup's non-key columns must not clash
    with the fact's.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how}")
    broadcast_rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    if fits(lookup, broadcast_rows):
        return _join(fact, F.broadcast(lookup), keys, how, residual, null_safe)

    hot = heavy_keys(fact.select(*keys), keys, HOT_SHARE if hot_share is None else hot_share)
    hot_lookup = lookup.join(F.broadcast(hot), _equal(lookup, hot, keys, True), "left_semi")
    if not fits(hot_lookup, broadcast_rows):
        return _join(fact, lookup, keys, how, residual, null_safe)
    has_null = reduce(or_, [F.col(k).isNull() for k in keys])
    marked = fact.join(
        F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))),
        reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]),
        "left",
    ).drop(*[f"_hot_{k}" for k in keys])
    aside = F.coalesce(F.col("_hot"), F.lit(False))
    if not null_safe:
        aside = aside | has_null
    spread = marked.filter(aside).drop("_hot")
    moved = marked.filter(~aside).drop("_hot")
    return _join(spread, F.broadcast(hot_lookup), keys, how, residual, null_safe).unionByName(
        _join(moved, lookup, keys, how, residual, null_safe)
    )


def _equal(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    pairs = [left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys]
    return reduce(and_, pairs)


def _join(fact, lookup, keys, how, residual, null_safe) -> DataFrame:
    renamed = lookup.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in lookup.columns if c not in keys]
    )
    match = reduce(
        and_,
        [
            F.col(k).eqNullSafe(F.col(f"_key_{k}")) if null_safe else F.col(k) == F.col(f"_key_{k}")
            for k in keys
        ],
    )
    if residual is not None:
        match = match & residual
    return fact.join(renamed, match, how).drop(*[f"_key_{k}" for k in keys])


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Return ``df``, or raise when a key occurs twice."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{what}: key {[twice[0][k] for k in keys]} occurs {twice[0]['n']} times")
    return df
