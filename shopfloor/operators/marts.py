"""OEE tables: per run, machine, line, day, week and shift.

Functions take and return unsorted DataFrames; the plans sort where a table is meant to be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions import kpi
from shopfloor.functions.rounding import Rounder, half_up
from shopfloor.operators.joins import lookup_join
from shopfloor.operators.ordering import with_ranks
from shopfloor.session import stage

PLANNED = "planned_production_min"
RATIOS = ("availability", "performance", "quality", "oee")


def run_oee(runs: DataFrame, products: DataFrame, planned: str = PLANNED, strict: bool = False) -> DataFrame:
    """OEE = availability x performance x quality of every run.

    A run whose product has no ideal cycle time keeps performance 1.0 unless ``strict``.
    """
    timed = lookup_join(runs, products.select("product_id", "ideal_cycle_time_sec"), ["product_id"])
    run_time = F.col(planned) - F.col("downtime_min")
    return (
        timed.withColumn("run_time_min", run_time)
        .withColumns(
            {
                "availability": kpi.availability(F.col("run_time_min"), F.col(planned)),
                "performance": kpi.performance(
                    F.col("ideal_cycle_time_sec"), F.col("total_units"), F.col("run_time_min"), strict
                ),
                "quality": kpi.quality(F.col("good_units"), F.col("total_units")),
                "scrap_units": F.col("total_units") - F.col("good_units"),
            }
        )
        .withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))
    )


def machine_totals(oee: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    """Mean KPIs and totals per machine.

    Means are over runs and unweighted; the scrap rate is a ratio of sums.
    """
    totals = oee.groupBy("machine_id").agg(
        *[rnd(F.avg(c), 3).alias(f"avg_{c}") for c in RATIOS],
        F.sum("downtime_min").alias("total_downtime_min"),
        F.sum("total_units").alias("total_units"),
        F.sum("scrap_units").alias("total_scrap"),
    )
    return totals.withColumn("scrap_rate", rnd(F.try_divide(F.col("total_scrap"), F.col("total_units")), 3))


def oee_by_machine(oee: DataFrame, machines: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    """The machine totals with the machine's current attributes."""
    attributes = machines.select("machine_id", "machine_name", "line", "machine_type")
    return machine_totals(oee, rnd).join(attributes, "machine_id", "left")


def oee_by_machine_basic(oee: DataFrame, machines: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    """The same mart in its second column layout: unprefixed KPIs, the whole machine row, no unit totals."""
    totals = oee.groupBy("machine_id").agg(
        *[rnd(F.avg(c), 3).alias(c) for c in RATIOS],
        F.sum("downtime_min").alias("total_downtime_min"),
        rnd(F.try_divide(F.sum("scrap_units"), F.sum("total_units")), 3).alias("scrap_rate"),
    )
    return totals.join(machines, "machine_id", "left")


def oee_by_line(oee: DataFrame, machines: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    """Mean OEE over all runs of a line.

    Runs are summed per machine before the machine's line is looked up, so the join sees one row
    per machine however many runs the machine has.
    """
    per_machine = oee.groupBy("machine_id").agg(
        F.sum("oee").alias("_oee"),
        F.count("oee").alias("_runs"),
        F.sum("downtime_min").alias("_down"),
        F.sum("total_units").alias("_units"),
    )
    return (
        per_machine.join(machines.select("machine_id", "line"), "machine_id", "left")
        .groupBy("line")
        .agg(
            rnd(F.try_divide(F.sum("_oee"), F.sum("_runs")), 3).alias("avg_oee"),
            F.sum("_down").alias("total_downtime_min"),
            F.sum("_units").alias("total_units"),
        )
    )


def daily_oee(oee: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    return oee.groupBy("machine_id", "run_date").agg(
        rnd(F.avg("oee"), 3).alias("daily_oee"), F.sum("downtime_min").alias("downtime_min")
    )


def rolling_oee(daily: DataFrame, days: int = 7, calendar: bool = False, rnd: Rounder = half_up) -> DataFrame:
    """Mean of the last ``days`` daily values per machine.

    The frame counts rows, so a gap in the dates stretches it; ``calendar`` counts days instead.
    A window group holds one machine's days, which the calendar bounds.
    """
    by_machine = Window.partitionBy("machine_id")
    if calendar:
        frame = by_machine.orderBy(F.unix_date("run_date")).rangeBetween(-(days - 1), 0)
    else:
        frame = by_machine.orderBy("run_date").rowsBetween(-(days - 1), 0)
    return daily.withColumn(f"rolling_{days}d_oee", rnd(F.avg("daily_oee").over(frame), 3))


def weekly_oee(daily: DataFrame, iso_year: bool = False, rnd: Rounder = half_up) -> DataFrame:
    """Mean daily OEE over all machines per year and ISO week.

    The calendar year and the ISO week part ways around New Year; ``iso_year`` takes the week's own year.
    """
    year = F.extract(F.lit("YEAROFWEEK"), F.col("run_date")) if iso_year else F.year("run_date")
    return (
        daily.groupBy(year.alias("year"), F.weekofyear("run_date").alias("week"))
        .agg(rnd(F.avg("daily_oee"), 3).alias("weekly_oee"))
    )


def shift_performance(oee: DataFrame, rnd: Rounder = half_up) -> DataFrame:
    return oee.groupBy("shift").agg(*[rnd(F.avg(c), 3).alias(c) for c in ("oee", "availability", "performance")])


def running_downtime(daily: DataFrame) -> DataFrame:
    """Downtime of each machine accumulated day by day (one row per machine and day)."""
    so_far = Window.partitionBy("machine_id").orderBy("run_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "machine_id", "run_date", "downtime_min", F.sum("downtime_min").over(so_far).alias("running_downtime_min")
    )


def rank_in_line(mart: DataFrame, kpi_col: str = "avg_oee") -> DataFrame:
    """Rank and dense rank of each machine within its line, best first.

    A line may hold any number of machines: ranks come from the distinct KPI values per line.
    """
    rows = stage(mart.select("machine_id", "line", kpi_col), "line-ranks")
    return with_ranks(rows, kpi_col, ["line"], descending=True, rank="line_rank", dense_rank="line_dense_rank")


def overall_oee(mart: DataFrame, kpi_col: str = "avg_oee", rnd: Rounder = half_up) -> DataFrame:
    """Dashboard figure: mean over the machines' OEE."""
    return mart.agg(rnd(F.avg(kpi_col), 3).alias("overall_oee"), F.count("*").alias("machines"))


def dashboard_oee_by_line(mart: DataFrame, kpi_col: str = "avg_oee", rnd: Rounder = half_up) -> DataFrame:
    """Dashboard bar chart: mean over the machines of each line (not over their runs)."""
    return mart.groupBy("line").agg(rnd(F.avg(kpi_col), 3).alias("avg_machine_oee"), F.count("*").alias("machines"))
