"""Path-addressed lake: bronze -> silver -> history -> gold, each step a batch job of its own."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.functions.cleaning import parsed_timestamp, standard_code
from shopfloor.operators import gates, health, history, marts, merge
from shopfloor.operators.telemetry import clean_readings
from shopfloor.plans.refresh import IncrementalGold
from shopfloor.sources import files
from shopfloor.sources.versioned import VersionedTable
from shopfloor.sources.drift import FieldLedger
from shopfloor.streaming.gates import GatedTable, gate_available
from shopfloor.streaming.ingest import ingest_available, landed_json


@dataclass(frozen=True)
class Lake:
    """Where the layers lie. ``fmt`` may be any format the session can read and write."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return files.read_table(spark, self.path(layer, name), self.fmt)

    def write(self, df: DataFrame, layer: str, name: str, partition_by: str | None = None) -> int:
        return files.write_table(df, self.path(layer, name), self.fmt, partition_by)

    def machine_history(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable(spark, self.path("silver", "dim_machine_scd2"), self.fmt)


# Landing folder, file-name filter and contract of each source; fixed names.
SOURCES = {
    "dim_machines": ("mes", "machines.json", schemas.MACHINES),
    "dim_products": ("mes", "products.json", schemas.PRODUCTS),
    "mes_runs": ("mes", "runs_*.json", schemas.RUNS),
    "sensors": ("sensors", None, schemas.SENSORS),
    "quality": ("quality", None, schemas.QUALITY),
}


DIMENSIONS = ("dim_machines", "dim_products")


def _landed(spark: SparkSession, landing: str, name: str) -> DataFrame:
    folder, pattern, contract = SOURCES[name]
    return files.read_landed(spark, f"{landing.rstrip('/')}/{folder}", contract, pattern)


def bronze(spark: SparkSession, landing: str, lake: Lake, infer: bool = False) -> dict[str, int]:
    """Copy every source, with lineage columns; returns the rows landed per table.

    Broken lines, misfitting values and undeclared fields are kept (``files.parse_lines``). With ``infer``
    the columns are those found in the files.
    """
    landed = {}
    for name, (folder, pattern, _) in SOURCES.items():
        path = f"{landing.rstrip('/')}/{folder}"
        raw = files.read_json(spark, path, glob_filter=pattern) if infer else _landed(spark, landing, name)
        landed[name] = lake.write(raw, "bronze", name)
    return landed


def bronze_incremental(spark: SparkSession, landing: str, lake: Lake) -> None:
    """Append only the fact files that landed since the last call, each exactly once; load the dimensions anew.

    Dimension files are edited in place, so each call takes them whole. The state lies in the lake. A
    bronze table is fed either this way or by ``bronze``, not by both.
    """
    for name, (folder, pattern, contract) in SOURCES.items():
        if name in DIMENSIONS:
            lake.write(_landed(spark, landing, name), "bronze", name)
            continue
        stream = landed_json(spark, f"{landing.rstrip('/')}/{folder}", contract, pattern, lossless=True)
        ingest_available(stream, lake.path("bronze", name), lake.path("_checkpoints", name), lake.fmt)


def _clean_quality(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"inspected_ts": parsed_timestamp(F.col("inspected_ts")), "result": standard_code(F.col("result"))})


# How each fact is cleaned, and the gate it passes.
GATED: dict[str, tuple[Callable[[DataFrame], DataFrame], gates.Gate]] = {
    "mes_runs": (lambda raw: raw, gates.RUN_GATE),
    "sensors": (clean_readings, gates.SENSOR_GATE),
    "quality": (_clean_quality, gates.QUALITY_GATE),
}


def silver(spark: SparkSession, lake: Lake, promote: bool = False) -> dict[str, dict[str, int]]:
    """Clean, flatten and gate each source in one pass; returns valid and quarantined counts.

    With ``promote`` the fields that no contract declares become typed columns, beside those of the flatten.
    """
    counts = {}
    for name, (clean, gate) in GATED.items():
        raw = lake.read(spark, "bronze", name)
        df = clean(raw)
        if promote and files.UNDECLARED in raw.columns:
            ledger = FieldLedger(spark, lake.path("_fields", name))
            ledger.learn(raw.select(files.UNDECLARED))
            df = ledger.promoted(df) if files.UNDECLARED in df.columns else df
        counts[name] = gates.write_split(df, gate, lake.path("silver", name), lake.fmt)
    return counts


def silver_table(spark: SparkSession, lake: Lake, name: str, quarantine: bool = False) -> DataFrame:
    """``mes_runs``, ``sensors`` or ``quality``: the accepted rows, or the quarantined ones."""
    written = lake.read(spark, "silver", name).drop("is_valid")
    return gates.read_half(spark, lake.path("silver", name), written.schema, not quarantine, lake.fmt)


def gated_table(spark: SparkSession, lake: Lake, name: str) -> GatedTable:
    """A fact's silver table as ``refresh`` keeps it: by batch and half."""
    clean, _ = GATED[name]
    return GatedTable(spark, lake.path("silver", f"{name}_gated"), clean(lake.read(spark, "bronze", name)).schema)


def silver_incremental(spark: SparkSession, lake: Lake) -> dict[str, dict[str, int]]:
    """Gate what ``bronze_incremental`` has added since the last call; returns the counts of all batches so far."""
    counts = {}
    for name, (clean, gate) in GATED.items():
        raw = lake.read(spark, "bronze", name)
        stream = spark.readStream.format(lake.fmt).schema(raw.schema).load(lake.path("bronze", name))
        table = gated_table(spark, lake, name)
        gate_available(stream, table, gate, lake.path("_checkpoints", f"{name}_gated"), clean)
        total = table.counts().agg(F.coalesce(F.sum("valid"), F.lit(0)).alias("valid"), F.coalesce(F.sum("quarantine"), F.lit(0)).alias("quarantine"))
        counts[name] = total.first().asDict()
    return counts


def incremental_gold(spark: SparkSession, lake: Lake) -> IncrementalGold:
    """The run facts by day, their states, and the marts made of these."""
    return IncrementalGold(spark, lake.path("silver", "run_oee_by_day"), order=("ingested_at",))


def refresh(spark: SparkSession, landing: str, lake: Lake) -> dict[str, int]:
    """Take what has landed since the last call through all layers; returns the rows of each mart.

    New files are appended to bronze, gated batch by batch, and the accepted runs upserted by ``run_id`` (the
    one ingested last counts) into the days they belong to. Marts are rebuilt from states, of which those of
    touched days are worked out anew; runs of other days are not read. A run keeps the cycle time its product
    had when it was taken.
    """
    bronze_incremental(spark, landing, lake)
    silver_incremental(spark, lake)
    gold, runs = incremental_gold(spark, lake), gated_table(spark, lake, "mes_runs")
    products = lake.read(spark, "bronze", "dim_products")
    for batch in runs.batches(after=gold.last_batch()):
        good = runs.read(True, [batch]).select(*schemas.RUNS.names)
        oee = marts.run_oee(merge.latest_per_key(good, ["run_id"], ["ingested_at"]), products)
        gold.take(oee.withColumn("run_date", F.to_date("run_date")), batch)
    machines = lake.read(spark, "bronze", "dim_machines").select("machine_id", "machine_name", "line", "machine_type")
    return {name: lake.write(mart, "gold", name) for name, mart in gold.marts(machines).items()}


def machine_history(spark: SparkSession, lake: Lake, effective: date | str | None = None) -> int:
    """Apply the landed machine snapshot to the dimension's history; returns the version written."""
    snapshot = lake.read(spark, "bronze", "dim_machines").select(*schemas.MACHINES.names)
    table = lake.machine_history(spark)
    if not table.exists():
        return table.overwrite(history.open_history(snapshot, effective))
    return table.overwrite(history.apply_snapshot(table.read(), snapshot, effective))


def gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Run OEE and the three marts; every mart reads the written run OEE and machine mart."""
    machines = lake.machine_history(spark).read().filter("is_current").select(
        "machine_id", "machine_name", "line", "machine_type"
    )
    products = lake.read(spark, "bronze", "dim_products")
    runs = silver_table(spark, lake, "mes_runs").drop("_ingest_time", "_source_file", files.CORRUPT, files.UNDECLARED)
    written = {"run_oee": lake.write(marts.run_oee(runs, products), "silver", "run_oee", partition_by="run_date")}
    oee = lake.read(spark, "silver", "run_oee")

    by_machine = marts.oee_by_machine(oee, machines).orderBy("machine_id")
    written["gold_oee_by_machine"] = lake.write(by_machine, "gold", "gold_oee_by_machine")
    by_line = marts.oee_by_line(oee, machines).orderBy("line")
    written["gold_oee_by_line"] = lake.write(by_line, "gold", "gold_oee_by_line")
    joined = health.machine_health(
        machines,
        lake.read(spark, "gold", "gold_oee_by_machine"),
        silver_table(spark, lake, "sensors"),
        silver_table(spark, lake, "quality"),
    ).orderBy("machine_id")
    written["gold_machine_health"] = lake.write(joined, "gold", "gold_machine_health")
    return written
