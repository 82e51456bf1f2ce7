"""Downtime losses: taxonomy, reason totals and Pareto."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions.rounding import Rounder, half_up
from shopfloor.operators.ordering import prefix_sums

# Reason, loss category, planned type.
LOSS_TAXONOMY = [
    ("Breakdown", "Availability", "Unplanned"),
    ("Changeover", "Availability", "Planned"),
    ("Planned Maintenance", "Availability", "Planned"),
    ("Minor Stop", "Performance", "Unplanned"),
    ("Reduced Speed", "Performance", "Unplanned"),
    ("Material Starvation", "Availability", "Unplanned"),
]


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOSS_TAXONOMY, "reason string, loss_category string, planned_type string")


def categorise(events: DataFrame) -> DataFrame:
    """Attach category and planned type by reason (a six-row lookup, safe to broadcast)."""
    return events.join(F.broadcast(taxonomy(events.sparkSession)), "reason", "left")


def loss_taxonomy(events: DataFrame) -> DataFrame:
    return events.groupBy("loss_category", "planned_type").agg(
        F.sum("duration_min").alias("total_downtime_min"), F.count("*").alias("event_count")
    )


def downtime_by_category(events: DataFrame) -> DataFrame:
    return events.groupBy("loss_category").agg(
        F.sum("duration_min").alias("total_downtime_min"), F.count("*").alias("event_count")
    )


def pareto(events: DataFrame, key: str = "reason", value: str = "duration_min", rnd: Rounder = half_up) -> DataFrame:
    """Share and cumulative share of each key, largest total first; ties go by key.

    Grand total and running total come from the key totals inside the plan, so any number of
    distinct keys will do.
    """
    totals = events.groupBy(key).agg(F.sum(value).alias("total_min"), F.count("*").alias("events"))
    summed = prefix_sums(totals, [("total_min", True), (key, False)], ["total_min"])
    running = F.coalesce("before_total_min", F.lit(0)) + F.coalesce("total_min", F.lit(0))
    return summed.select(
        key,
        "total_min",
        "events",
        rnd(F.try_divide(F.col("total_min"), F.col("total_total_min")) * 100, 1).alias("pct_of_total"),
        rnd(F.try_divide(running, F.col("total_total_min")) * 100, 1).alias("cumulative_pct"),
    )
