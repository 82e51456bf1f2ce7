"""Dimension history (SCD type 2) on plain DataFrames."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from shopfloor.operators.joins import fits, require_unique
from shopfloor.session import stage

TRACKED = ["line", "maintenance_tier"]
#: Versions of a key, at most, that a fact is held against one by one.
FEW_VERSIONS = 8


def _live() -> Column:
    """Current versions; a NULL flag is not one, and its row is history."""
    return F.coalesce(F.col("is_current"), F.lit(False))


def require_keys(snapshot: DataFrame, key: str) -> DataFrame:
    """Return ``snapshot``, or raise when a key is NULL or occurs twice."""
    if not snapshot.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"snapshot: {key} is NULL")
    return require_unique(snapshot, [key], "snapshot")


def _day(value: date | str | Column | None) -> Column:
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def open_history(snapshot: DataFrame, effective: date | str | Column | None = None, key: str = "machine_id", checked: bool = False) -> DataFrame:
    """Stamp every row of a snapshot as a current version.

    A NULL or repeated key is refused, unless the caller has ``checked`` that there is none.
    """
    return (snapshot if checked else require_keys(snapshot, key)).withColumns(
        {
            "valid_from": _day(effective),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def classify(
    existing: DataFrame, snapshot: DataFrame, key: str = "machine_id", tracked: list[str] | None = None
) -> DataFrame:
    """The snapshot with ``cur_*`` values of the current version and ``change`` = new / changed / unchanged.

    A match is known from the join itself and values are compared NULL-safely, so a NULL attribute
    is neither mistaken for a new machine nor for an unchanged one.
    """
    tracked = tracked or TRACKED
    current = existing.filter(_live()).select(
        F.col(key), *[F.col(c).alias(f"cur_{c}") for c in tracked], F.lit(True).alias("_known")
    )
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"cur_{c}")) for c in tracked])
    change = (
        F.when(F.col("_known").isNull(), F.lit("new")).when(differs, F.lit("changed")).otherwise(F.lit("unchanged"))
    )
    return snapshot.join(current, key, "left").withColumn("change", change).drop("_known")


def to_expire(
    existing: DataFrame, classified: DataFrame, effective: date | str | Column | None = None, key: str = "machine_id"
) -> DataFrame:
    """Current versions that a change replaces, closed on the effective day."""
    changed = classified.filter("change = 'changed'").select(key)
    return (
        existing.filter(_live())
        .join(changed, key, "left_semi")
        .withColumns({"valid_to": _day(effective), "is_current": F.lit(False)})
    )


def to_keep(existing: DataFrame, classified: DataFrame, key: str = "machine_id") -> DataFrame:
    """Current versions that stay as they are, including machines the snapshot does not list."""
    changed = classified.filter("change = 'changed'").select(key)
    return existing.filter(_live()).join(changed, key, "left_anti")


def apply_snapshot(
    existing: DataFrame,
    snapshot: DataFrame,
    effective: date | str | Column | None = None,
    key: str = "machine_id",
    tracked: list[str] | None = None,
) -> DataFrame:
    """The dimension after one snapshot: history, kept, expired and new versions in a single join.

    Each key has at most one current version and one incoming row, so one full outer join sees
    every case, and each pair unfolds into the one or two rows it leaves behind. A NULL or repeated
    key is refused, and so is a change that is dated before the version it would close. A second change
    on the day a version began replaces that version.
    """
    tracked = tracked or TRACKED
    columns = existing.columns
    require_keys(snapshot, key)
    incoming = open_history(snapshot, effective, checked=True).select(*columns)

    cur = existing.filter(_live()).select(F.col(key).alias("_k"), F.struct(*columns).alias("_cur"))
    new = incoming.select(F.col(key).alias("_k"), F.struct(*columns).alias("_new"))
    differs = reduce(or_, [~F.col(f"_cur.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in tracked])
    closed = F.struct(
        *[
            _day(effective).alias(c)
            if c == "valid_to"
            else F.lit(False).alias(c)
            if c == "is_current"
            else F.col(f"_cur.{c}").alias(c)
            for c in columns
        ]
    )
    existing_type = StructType(existing.select(*columns).schema.fields)
    backdated = F.col("_cur.valid_from") > F.col("_new.valid_from")
    same_day = F.col("_cur.valid_from") == F.col("_new.valid_from")
    too_early = F.concat(F.lit(f"{key} "), F.col("_k").cast("string"), F.lit(": change before "), F.col("_cur.valid_from").cast("string"))
    versions = (
        F.when(F.col("_new").isNull(), F.array("_cur"))
        .when(F.col("_cur").isNull(), F.array("_new"))
        .when(differs & backdated, F.array(F.raise_error(too_early).cast(existing_type)))
        .when(differs & same_day, F.array("_new"))
        .when(differs, F.array(closed, F.col("_new")))
        .otherwise(F.array("_cur"))
    )
    live = cur.join(new, "_k", "full_outer").select(F.inline(versions))
    return existing.filter(~_live()).unionByName(live)


def versions_of(observations: DataFrame, day: str = "observed", key: str = "machine_id", tracked: list[str] | None = None, order: str | None = None) -> DataFrame:
    """The dimension that observations of keys on days add up to, whatever order they came in.

    An observation (one row for a key and a day; ``day`` is its column) says what the tracked columns were on
    that day. Days on which they stay the same, compared NULL-safely, are one version; it begins on the first
    of them, with that day's other columns, and ends where the next one begins. If a key was observed several
    times on a day, the last by ``order`` counts; without ``order`` that is refused, as NULL keys and days are.
    All versions are cut in one pass: one shuffle by key.
    """
    tracked = tracked or TRACKED
    known = F.col(key).isNotNull() & F.col(day).isNotNull()
    if not observations.filter(~known).isEmpty():
        raise ValueError(f"observations: {key} or {day} is NULL")
    others = [c for c in observations.columns if c not in (day, order)]
    if order:
        newest = F.max_by(F.struct(*others), F.col(order)).alias("_row")
        observations = observations.groupBy(F.col(key).alias("_k"), day).agg(newest).select("_row.*", day)
    else:
        require_unique(observations, [key, day], "observations")
    by_key = Window.partitionBy(key).orderBy(day)
    before = F.lag(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(tracked)])).over(by_key)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_before._{i}")) for i, c in enumerate(tracked)])
    starts = observations.withColumn("_before", before).filter(F.col("_before").isNull() | ~same).drop("_before")
    return starts.withColumn("valid_to", F.lead(day).over(by_key)).select(
        *others, F.col(day).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current")
    )


def observations_of(dimension: DataFrame, day: str = "observed") -> DataFrame:
    """A dimension as observations: each version on the day it begins. Days on which it was merely confirmed are not known any more."""
    began = F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))
    return dimension.filter(began).withColumnRenamed("valid_from", day).drop("valid_to", "is_current")


class ObservedHistory:
    """Snapshots kept by day, in any order of arrival, and the dimension they make.

    Confirmations count: a back-dated change holds only until the next snapshot that said otherwise. That is
    lost in a dimension alone, so the snapshots themselves are kept, a folder for each day. A day that is
    delivered again replaces its folder.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "machine_id", tracked: list[str] | None = None):
        self.spark, self.path, self.schema, self.key, self.tracked = spark, path.rstrip("/"), schema, key, tracked

    def add(self, snapshot: DataFrame, day: date | str) -> None:
        """Keep the snapshot of ``day``; a NULL or repeated key is refused."""
        require_keys(snapshot, self.key).select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/observed={day}")

    def observations(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("observed", DateType())])).parquet(self.path)

    def dimension(self) -> DataFrame:
        return versions_of(self.observations(), key=self.key, tracked=self.tracked)


def as_of(dimension: DataFrame, day: date | str | Column) -> DataFrame:
    """The versions that were valid on ``day``."""
    on = _day(day)
    return dimension.filter((F.col("valid_from") <= on) & (F.col("valid_to").isNull() | (on < F.col("valid_to"))))


def as_of_join(facts: DataFrame, dimension: DataFrame, day_col: str, attributes: list[str], key: str = "machine_id", few: int = FEW_VERSIONS) -> DataFrame:
    """Attach to each fact the attributes its key had on the fact's own day; a fact stays one row.

    The version that began last on or before the day counts (of several the one that ends last); if it has
    ended by then, there is none. A dimension of few
    versions for each key that fits a broadcast is looked up; else facts and versions are merged in order.
    """
    versions = dimension.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_key"), "valid_from", "valid_to", F.struct(*attributes).alias("_attributes")
    )
    most = versions.groupBy("_key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= few and fits(dimension.select(key, "valid_from", "valid_to", *attributes)):
        placed = _looked_up(facts, versions, day_col, key)
    else:
        placed = _merged(facts, versions, day_col, key)
    return placed.select(*facts.columns, *[F.col(f"_attributes.{a}").alias(a) for a in attributes])


def _last_version() -> Column:
    """What a version is ordered by: the day it begins, then the day it ends."""
    return F.struct("valid_from", F.coalesce("valid_to", F.lit(date(9999, 12, 31))))


def _looked_up(facts: DataFrame, versions: DataFrame, day_col: str, key: str) -> DataFrame:
    """Each fact with ``_attributes``; the versions of a key are broadcast as one short list."""
    listed = versions.groupBy("_key").agg(F.collect_list(F.struct(_last_version().alias("_last"), "valid_from", "valid_to", "_attributes")).alias("_versions"))
    joined = facts.join(F.broadcast(listed), F.col(key) == F.col("_key"), "left")
    day = F.col(day_col)
    begun = F.filter("_versions", lambda v: v["valid_from"] <= day)
    newest = F.array_max(F.transform(begun, lambda v: v["_last"]))
    best = F.try_element_at(F.filter(begun, lambda v: v["_last"] == newest), F.lit(1))
    return joined.withColumn("_attributes", F.when(best["valid_to"].isNull() | (day < best["valid_to"]), best["_attributes"]))


def _merged(facts: DataFrame, versions: DataFrame, day_col: str, key: str) -> DataFrame:
    """Each fact with ``_attributes``, by one ordered pass over facts and versions.

    Both are dealt into slices by ranges of key and day, so a key of very many facts or versions is spread
    over slices. Within a slice the last version is carried from row to row; where a key goes on from the
    slices before, the last version there is carried over, one row for each slice.
    """
    spread = F.xxhash64(*facts.columns)  # facts of one key and day may be very many
    rows = facts.filter(F.col(key).isNotNull() & F.col(day_col).isNotNull()).select(
        F.col(key).alias("_key"), F.col(day_col).cast("date").alias("_day"), F.lit(True).alias("_is_fact"), spread.alias("_spread"), F.struct(*facts.columns).alias("_fact"),
        F.lit(None).cast(versions.select(F.struct("valid_from", "valid_to", "_attributes").alias("v")).schema["v"].dataType).alias("_version"),
    )
    ends = F.coalesce(F.datediff("valid_to", F.lit(date(1970, 1, 1))), F.lit(2**31 - 1)).cast("bigint")
    starts = versions.select(
        "_key", F.col("valid_from").alias("_day"), F.lit(False).alias("_is_fact"), ends.alias("_spread"), F.lit(None).cast(rows.schema["_fact"].dataType).alias("_fact"),
        F.struct("valid_from", "valid_to", "_attributes").alias("_version"),
    )
    order = ["_day", "_is_fact", "_spread"]
    dealt = rows.unionByName(starts).repartitionByRange("_key", *order)
    sliced = stage(dealt.withColumn("_slice", F.spark_partition_id()), "as-of-slices")
    # The last version of each key in a slice, where the key goes on in another.
    held = sliced.groupBy("_key", "_slice").agg(F.max_by("_version", F.when(~F.col("_is_fact"), F.struct("_day", "_spread"))).alias("_last"))
    spanning = held.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key")
    ahead = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = held.join(spanning, "_key", "left_semi").withColumn("_carried", F.last("_last", ignorenulls=True).over(ahead)).filter("_carried IS NOT NULL")
    carried = carried.select(F.col("_key").alias("_c_key"), F.col("_slice").alias("_c_slice"), "_carried")
    so_far = Window.partitionBy("_slice", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = sliced.withColumn("_here", F.last("_version", ignorenulls=True).over(so_far)).filter("_is_fact")
    joined = here.join(carried, (F.col("_slice") == F.col("_c_slice")) & (F.col("_key") == F.col("_c_key")), "left")
    found = F.coalesce("_here", "_carried")
    valid = found["valid_to"].isNull() | (F.col("_day") < found["valid_to"])
    placed = joined.select("_fact.*", F.when(valid, found["_attributes"]).alias("_attributes"))
    unplaced = facts.filter(F.col(key).isNull() | F.col(day_col).isNull()).withColumn("_attributes", F.lit(None).cast(placed.schema["_attributes"].dataType))
    return placed.unionByName(unplaced)
