"""Catalog tables: the bronze, silver and gold tables of one schema, built from source frames."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.operators import gates, health, history, losses, marts, merge
from shopfloor.session import stage, work_folder
from shopfloor.sources import catalog
from shopfloor.sources.files import delete_path

TABLES = [
    "bronze_dim_machines", "bronze_dim_products", "bronze_mes_runs", "bronze_downtime_events", "bronze_sensors",
    "bronze_quality", "silver_mes_runs", "silver_mes_runs_quarantine", "silver_run_oee", "gold_oee_by_machine",
    "gold_daily_oee", "gold_weekly_oee", "gold_shift_performance", "gold_loss_taxonomy", "gold_downtime_pareto",
    "gold_machine_health", "gold_failure_risk", "dim_machine_scd2",
]


class Warehouse:
    """Tables of the current schema. With ``location`` they are external tables below that folder."""

    def __init__(self, spark: SparkSession, location: str | None = None, fmt: str = "parquet"):
        self.spark, self.location, self.fmt = spark, location, fmt

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return catalog.overwrite(df, name, self._path(name), self.fmt)

    def _path(self, name: str) -> str | None:
        # A folder per write, so a table can be rebuilt from itself.
        return f"{self.location}/{name}-{uuid.uuid4().hex[:8]}" if self.location else None

    def reset(self) -> None:
        catalog.drop(self.spark, *TABLES)

    def bronze(
        self, machines: DataFrame, products: DataFrame, runs: DataFrame, events: DataFrame, sensors: DataFrame, quality: DataFrame
    ) -> None:
        self.save(machines, "bronze_dim_machines")
        self.save(products, "bronze_dim_products")
        self.save(runs, "bronze_mes_runs")
        self.save(events, "bronze_downtime_events")
        self.save(sensors, "bronze_sensors")
        self.save(quality, "bronze_quality")

    def silver(self, planned: str = "planned_min") -> None:
        raw = self.spark.table("bronze_mes_runs")
        # One pass over the raw runs writes both halves; the tables are copies of a half each.
        halves = work_folder(self.spark, "silver-halves")
        gates.write_split(raw, gates.RUN_GATE_BASIC, halves)
        runs = self.save(gates.read_half(self.spark, halves, raw.schema, True), "silver_mes_runs")
        self.save(gates.read_half(self.spark, halves, raw.schema, False), "silver_mes_runs_quarantine")
        delete_path(self.spark, halves)
        self.save(marts.run_oee(runs, self.spark.table("bronze_dim_products"), planned), "silver_run_oee")

    def gold(self) -> None:
        spark, oee = self.spark, self.spark.table("silver_run_oee")
        mart = self.save(marts.oee_by_machine_basic(oee, spark.table("bronze_dim_machines")), "gold_oee_by_machine")
        daily = self.save(marts.rolling_oee(marts.daily_oee(oee)), "gold_daily_oee")
        self.save(marts.weekly_oee(daily).orderBy("year", "week"), "gold_weekly_oee")
        self.save(marts.shift_performance(oee), "gold_shift_performance")

        events = spark.table("bronze_downtime_events")
        self.save(losses.loss_taxonomy(events).orderBy(F.desc("total_downtime_min")), "gold_loss_taxonomy")
        self.save(losses.pareto(events).orderBy(F.desc("total_min"), "reason"), "gold_downtime_pareto")

        joined = health.machine_health_basic(mart, spark.table("bronze_sensors"), spark.table("bronze_quality"))
        machine_health = self.save(joined, "gold_machine_health")
        risk = health.failure_risk(machine_health).orderBy(F.desc("failure_risk"), "machine_id")
        self.save(risk, "gold_failure_risk")

    def machine_history(self, updates: DataFrame, effective: date | str | None = None) -> DataFrame:
        """Create ``dim_machine_scd2`` from the bronze machines if absent, then merge ``updates``."""
        name = "dim_machine_scd2"
        if not catalog.exists(self.spark, name):
            first = history.open_history(self.spark.table("bronze_dim_machines"), effective)
            catalog.create(first, name, self._path(name), self.fmt)
        return merge_tiers(self, name, updates, effective)


def merge_tiers(warehouse: Warehouse, table: str, updates: DataFrame, effective: date | str | None = None) -> DataFrame:
    """Close current versions whose maintenance tier changed and open their successors, in one write.

    Machines the table does not know are left out, NULL tiers compare like values, and a NULL or repeated
    machine is refused. A machine is opened once a run: a second run on the same day with the same rows
    changes nothing, and another change on that day leaves the version of that day behind, closed.
    """
    spark = warehouse.spark
    history.require_keys(updates, "machine_id")
    day = F.current_date() if effective is None else F.lit(effective).cast("date")
    target = spark.table(table)
    changed = ~F.col("t.maintenance_tier").eqNullSafe(F.col("s.maintenance_tier"))
    current = F.coalesce(F.col("t.is_current"), F.lit(False))
    closed = merge.merge_df(
        target, updates, ["machine_id"], update={"is_current": F.lit(False), "valid_to": day}, when=changed, on=current
    )
    reopened = updates.alias("s").join(target.alias("t"), (F.col("s.machine_id") == F.col("t.machine_id")) & current & changed, "left_semi")
    stamps = {"valid_from": day, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
    opened = reopened.select(*[(stamps[f.name] if f.name in stamps else F.col(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return warehouse.save(stage(closed.unionByName(opened), "machine-versions"), table)
