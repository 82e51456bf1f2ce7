"""Every query by name, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shopfloor.functions.cleaning import padded_id, parsed_timestamp, standard_code
from shopfloor.functions.kpi import kelvin_to_celsius
from shopfloor.functions.rounding import steady
from shopfloor.operators import gates, health, history, learning, losses, marts, merge, ordering, telemetry
from shopfloor.plans.bindings import LEARNING_FEATURES, LEARNING_KEYS, Plant
from shopfloor.plans.oracle import ORACLE
from shopfloor.plans.refresh import IncrementalGold
from shopfloor.plans.warehouse import Warehouse, merge_tiers
from shopfloor.session import stage, work_folder
from shopfloor.sources import catalog, files
from shopfloor.sources.drift import FieldLedger
from shopfloor.sources.versioned import VersionedTable
from shopfloor.streaming.gates import GatedTable, gate_available
from shopfloor.streaming.ingest import ingest_available, landed_json
from shopfloor.streaming.upsert import upsert_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_LOAD, SECOND_LOAD = "2024-01-01", "2024-02-01"


def query(fn: Callable[[Plant], DataFrame]) -> Callable[[Plant], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Plant(spark, sf_dir))
    return fn


# --- gates -------------------------------------------------------------------


@query
def q_silver_runs(p: Plant) -> DataFrame:
    return p.silver_runs()


@query
def q_silver_runs_basic(p: Plant) -> DataFrame:
    return gates.accepted(p.runs(), gates.RUN_GATE_BASIC)


def _wall_clock(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


@query
def q_silver_sensors(p: Plant) -> DataFrame:
    return _wall_clock(p.silver_sensors(), "reading_ts")


@query
def q_silver_quality(p: Plant) -> DataFrame:
    return _wall_clock(p.silver_quality(), "inspected_ts")


@query
def q_quarantine_runs(p: Plant) -> DataFrame:
    return gates.quarantined(p.runs(), gates.RUN_GATE)


@query
def q_quarantine_sensors(p: Plant) -> DataFrame:
    flat = telemetry.clean_readings(p.raw_sensors())
    return _wall_clock(gates.quarantined(flat, gates.SENSOR_GATE), "reading_ts")


@query
def q_quarantine_quality(p: Plant) -> DataFrame:
    return _wall_clock(gates.quarantined(p.clean_quality(), gates.QUALITY_GATE), "inspected_ts")


@query
def q_load_audit(p: Plant) -> DataFrame:
    return gates.audit(
        {
            "mes_runs": (p.runs(), gates.RUN_GATE),
            "sensors": (telemetry.flatten_readings(p.raw_sensors()), gates.SENSOR_GATE),
            "quality": (p.clean_quality(), gates.QUALITY_GATE),
        }
    )


# --- OEE ---------------------------------------------------------------------


@query
def q_run_oee(p: Plant) -> DataFrame:
    oee = p.run_oee()
    return oee.select(
        "run_date", "machine_id", "product_id", "shift", "downtime_min", "total_units", "good_units",
        "ideal_cycle_time_sec", "run_time_min", "scrap_units",
        *[steady(F.col(c), 6).alias(c) for c in marts.RATIOS],
    )


def _mart(p: Plant) -> DataFrame:
    return marts.oee_by_machine(p.run_oee(), p.machines(), steady)


def _mart_basic(p: Plant) -> DataFrame:
    return marts.oee_by_machine_basic(p.run_oee(), p.machines(), steady)


@query
def q_oee_by_machine(p: Plant) -> DataFrame:
    return _mart(p).orderBy("machine_id")


@query
def q_oee_by_machine_basic(p: Plant) -> DataFrame:
    return _mart_basic(p)


@query
def q_oee_by_line(p: Plant) -> DataFrame:
    return marts.oee_by_line(p.run_oee(), p.machines(), steady).orderBy("line")


@query
def q_daily_oee(p: Plant) -> DataFrame:
    return marts.daily_oee(p.run_oee(), steady)


@query
def q_rolling_oee(p: Plant) -> DataFrame:
    return marts.rolling_oee(marts.daily_oee(p.run_oee(), steady), rnd=steady)


@query
def q_weekly_oee(p: Plant) -> DataFrame:
    return marts.weekly_oee(marts.daily_oee(p.run_oee(), steady), rnd=steady).orderBy("year", "week")


@query
def q_shift_performance(p: Plant) -> DataFrame:
    return marts.shift_performance(p.run_oee(), steady)


@query
def q_running_downtime(p: Plant) -> DataFrame:
    return marts.running_downtime(marts.daily_oee(p.run_oee(), steady))


@query
def q_rank_in_line(p: Plant) -> DataFrame:
    return marts.rank_in_line(_mart(p))


# --- losses ------------------------------------------------------------------


@query
def q_loss_taxonomy(p: Plant) -> DataFrame:
    return losses.loss_taxonomy(p.downtime_events()).orderBy(F.desc("total_downtime_min"))


@query
def q_downtime_by_category(p: Plant) -> DataFrame:
    return losses.downtime_by_category(p.downtime_events())


@query
def q_downtime_pareto(p: Plant) -> DataFrame:
    return losses.pareto(p.downtime_events(), rnd=steady).orderBy(F.desc("total_min"), "reason")


# --- health and risk ---------------------------------------------------------


@query
def q_sensor_agg(p: Plant) -> DataFrame:
    return health.sensor_agg(p.silver_sensors(), steady)


@query
def q_quality_agg(p: Plant) -> DataFrame:
    return health.quality_agg(p.silver_quality(), steady)


@query
def q_quality_agg_basic(p: Plant) -> DataFrame:
    return health.quality_agg_basic(p.silver_quality(), steady)


@query
def q_wear_by_machine(p: Plant) -> DataFrame:
    return health.wear_by_machine(p.silver_sensors(), steady).orderBy(F.desc("avg_wear"), "machine_id")


@query
def q_machine_health(p: Plant) -> DataFrame:
    totals = marts.machine_totals(p.run_oee(), steady)
    return health.machine_health(
        p.machines(), totals, p.silver_sensors(), p.silver_quality(), steady
    ).orderBy("machine_id")


def _health_basic(p: Plant) -> DataFrame:
    return health.machine_health_basic(_mart_basic(p), p.silver_sensors(), p.silver_quality(), steady)


@query
def q_machine_health_basic(p: Plant) -> DataFrame:
    return _health_basic(p)


@query
def q_kpi_correlation(p: Plant) -> DataFrame:
    return health.kpi_correlation(_health_basic(p), steady)


def _risk(p: Plant) -> DataFrame:
    return health.failure_risk(_health_basic(p), steady)


@query
def q_failure_risk(p: Plant) -> DataFrame:
    return _risk(p).orderBy(F.desc("failure_risk"), "machine_id")


@query
def q_top_risk(p: Plant) -> DataFrame:
    return health.top_risk(_risk(p))


@query
def q_oee_vs_risk(p: Plant) -> DataFrame:
    return health.oee_vs_risk(_risk(p))


@query
def q_overall_oee(p: Plant) -> DataFrame:
    return marts.overall_oee(marts.machine_totals(p.run_oee(), steady), rnd=steady)


@query
def q_dash_oee_by_line(p: Plant) -> DataFrame:
    return marts.dashboard_oee_by_line(_mart(p), rnd=steady)


# --- history -----------------------------------------------------------------


def _first_version(p: Plant) -> DataFrame:
    return history.open_history(p.snapshot(0), FIRST_LOAD)


def _dimension(p: Plant) -> DataFrame:
    return history.apply_snapshot(_first_version(p), p.snapshot(1), SECOND_LOAD)


@query
def q_scd2_init(p: Plant) -> DataFrame:
    """The first load of all machines."""
    table = VersionedTable(p.spark, work_folder(p.spark, "scd2-init"))
    columns = p.snapshot(0).columns
    if not table.exists():
        table.overwrite(history.open_history(p.machines().select(*columns), FIRST_LOAD))
    return table.read()


@query
def q_scd2_classify(p: Plant) -> DataFrame:
    return history.classify(_first_version(p), p.snapshot(1))


@query
def q_scd2_expire(p: Plant) -> DataFrame:
    existing = _first_version(p)
    return history.to_expire(existing, history.classify(existing, p.snapshot(1)), SECOND_LOAD)


@query
def q_scd2_keep(p: Plant) -> DataFrame:
    existing = _first_version(p)
    return history.to_keep(existing, history.classify(existing, p.snapshot(1)))


@query
def q_scd2_apply(p: Plant) -> DataFrame:
    table = VersionedTable(p.spark, work_folder(p.spark, "scd2-apply"))
    table.overwrite(_first_version(p))
    table.overwrite(history.apply_snapshot(table.read(), p.snapshot(1), SECOND_LOAD))
    return table.read()


@query
def q_scd2_merge(p: Plant) -> DataFrame:
    """Close versions whose tier changed and re-open them; some machines change once more on the same day."""
    name = f"dim_machine_scd2_{uuid.uuid4().hex[:12]}"
    store = Warehouse(p.spark, work_folder(p.spark, "scd2-merge"))
    store.save(_first_version(p), name)
    merge_tiers(store, name, p.snapshot(1), SECOND_LOAD)
    again = p.snapshot(1).filter("machine_id % 14 = 0").withColumn("maintenance_tier", F.lit("gold"))
    return merge_tiers(store, name, again, SECOND_LOAD)


@query
def q_scd2_as_of(p: Plant) -> DataFrame:
    """Downtime by the line and tier that a machine had on the day it stood still."""
    events = p.downtime_events().withColumn("day", F.date_add("event_date", 16))
    per_day = events.groupBy("machine_id", "day").agg(
        F.sum("duration_min").alias("minutes"), F.count("*").alias("n")
    )
    placed = history.as_of_join(per_day, _dimension(p), "day", ["line", "maintenance_tier"])
    return placed.groupBy("line", "maintenance_tier").agg(
        F.sum("minutes").alias("downtime_min"), F.sum("n").alias("events")
    )


@query
def q_scd2_backdated(p: Plant) -> DataFrame:
    """Four snapshots that arrive out of order; one confirms what an earlier one changed back."""
    first, second = p.snapshot(0), p.snapshot(1)
    golden = second.filter("machine_id % 3 = 0").withColumn("maintenance_tier", F.expr("CASE WHEN machine_id % 6 = 0 THEN 'gold' ELSE maintenance_tier END"))
    kept = history.ObservedHistory(p.spark, work_folder(p.spark, "scd2-backdated"), StructType(first.schema.fields))
    for snapshot, day in ((first, "2024-03-01"), (first, "2024-01-01"), (golden, "2024-04-01"), (second, "2024-02-01")):
        kept.add(snapshot, day)
    return kept.dimension()


@query
def q_scd2_as_of_many(p: Plant) -> DataFrame:
    """Quantity shipped by the status a machine had on the day: five machines, each with a version for every day of orders."""
    orders = p.table("orders").select((F.col("o_custkey") % 5).alias("machine_id"), F.col("o_orderdate").cast("date").alias("observed"), "o_orderkey", "o_orderpriority")
    statuses = orders.groupBy("machine_id", "observed").agg(F.min_by("o_orderpriority", "o_orderkey").alias("status"))
    dimension = history.versions_of(statuses, tracked=["status"])
    shipped = p.table("lineitem").select((F.col("l_suppkey") % 6).alias("machine_id"), F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    placed = history.as_of_join(shipped, dimension, "day", ["status"])
    return placed.groupBy("machine_id", "status").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.count("*").alias("items"))


@query
def q_fact_upsert(p: Plant) -> DataFrame:
    """Three batches: some orders have no year, a part moves to another year, and a part comes late with an old revision."""
    base = work_folder(p.spark, "fact-upsert")
    orders = p.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.lit(1).alias("revision"),
        F.expr("CASE WHEN o_orderkey % 17 <> 0 THEN year(o_orderdate) END").alias("o_year"),
    )
    first = orders.filter("o_orderkey % 10 <> 9")
    changed = orders.filter("o_orderkey % 3 = 0 OR o_orderkey % 10 = 9").withColumns(
        {"o_orderstatus": F.lit("C"), "revision": F.lit(3), "o_year": F.expr("CASE WHEN o_orderkey % 5 = 0 THEN o_year + 1 ELSE o_year END")}
    )
    late = orders.filter("o_orderkey % 2 = 0").withColumns({"o_orderstatus": F.lit("L"), "revision": F.lit(2)})
    for batch_id, batch in enumerate((first, changed, late)):
        merge.upsert_partitions(f"{base}/orders", batch, ["o_orderkey"], "o_year", batch_id, f"{base}/log", ["revision"])
    return p.spark.read.schema(orders.schema).parquet(f"{base}/orders")


@query
def q_gold_incremental(p: Plant) -> DataFrame:
    """Marts kept up to date: most runs, then late ones, then corrections that move some runs to another month."""
    gold = IncrementalGold(p.spark, work_folder(p.spark, "gold"), order=("revision",), period="month")
    runs = p.keyed_runs().withColumn("revision", F.lit(1))
    corrected = runs.filter("number % 7 = 0").withColumns(
        {"revision": F.lit(2), "downtime_min": F.col("downtime_min") + 15, "run_date": F.expr("CASE WHEN number % 2 = 0 THEN date_add(run_date, 40) ELSE run_date END")}
    )
    for batch_id, batch in enumerate((runs.filter("number % 10 <> 9"), runs.filter("number % 10 = 9"), corrected)):
        oee = marts.run_oee(gates.accepted(batch, gates.RUN_GATE), p.products())
        gold.take(oee.withColumn("month", F.date_format("run_date", "yyyy-MM")), batch_id)
    made = gold.marts(p.machines(), steady)
    machine = made["gold_oee_by_machine"].select(F.lit("machine").alias("mart"), "machine_id", F.lit(None).cast("date").alias("run_date"), "line", F.lit(None).cast("string").alias("shift"), F.col("avg_oee").alias("oee"), "avg_availability", F.col("total_downtime_min").alias("downtime_min"), "scrap_rate")
    parts = [
        made["gold_oee_by_line"].select(F.lit("line").alias("mart"), "line", F.col("avg_oee").alias("oee"), F.col("total_downtime_min").alias("downtime_min")),
        made["gold_daily_oee"].select(F.lit("day").alias("mart"), "machine_id", "run_date", F.col("daily_oee").alias("oee"), "downtime_min"),
        made["gold_shift_performance"].select(F.lit("shift").alias("mart"), "shift", "oee", F.col("availability").alias("avg_availability")),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, machine)


# --- files, catalog, streams -------------------------------------------------


@query
def q_bronze_json_roundtrip(p: Plant) -> DataFrame:
    """Land runs as NDJSON beside other files, read them back by folder and name filter, store as a table."""
    base = work_folder(p.spark, "bronze")
    runs = p.runs()
    runs.write.json(f"{base}/landing")
    p.machines().write.mode("append").option("compression", "gzip").json(f"{base}/landing")
    landed = files.read_json(p.spark, f"{base}/landing", runs.schema, glob_filter="*.json")
    files.write_table(landed, f"{base}/mes_runs")
    return files.read_table(p.spark, f"{base}/mes_runs").drop("_ingest_time", "_source_file")


@query
def q_bronze_drift(p: Plant) -> DataFrame:
    """Lines that are broken, that have a value of another type or an undeclared field: all is kept."""
    base = work_folder(p.spark, "drift")
    line = F.expr(
        """CASE WHEN event_id % 7 = 0 THEN concat('broken line ', event_id)
                WHEN event_id % 5 = 0 THEN concat('{"event_id": ', event_id, ', "value": 1.5, "operator": "op', event_id % 3, '"}')
                WHEN event_id % 3 = 0 THEN concat('{"event_id": ', event_id, ', "value": "12a"}')
                ELSE concat('{"event_id": ', event_id, ', "value": 2.5}') END"""
    )
    p.table("events").select(line.alias("value")).write.text(f"{base}/landing")
    contract = StructType([StructField("event_id", LongType()), StructField("value", DoubleType())])
    files.write_table(files.read_landed(p.spark, f"{base}/landing", contract), f"{base}/bronze")
    return files.read_table(p.spark, f"{base}/bronze").select(
        "event_id", "value", F.col(files.UNDECLARED)["operator"].alias("operator"), F.col(files.CORRUPT).alias("kept_line")
    )


@query
def q_bronze_promotion(p: Plant) -> DataFrame:
    """Two loads with undeclared fields: their types are learnt after each, widened by the second, and the fields read as columns."""
    base = work_folder(p.spark, "promotion")
    contract = StructType([StructField("event_id", LongType())])
    ledger = FieldLedger(p.spark, f"{base}/fields")
    loads = (
        """concat('{"event_id": ', event_id, ', "operator": "op', event_id % 3, '", "speed": ', event_id % 50, ', "code": "00', event_id % 5, '", "ok": ', event_id % 2 = 0, '}')""",
        """concat('{"event_id": ', event_id, CASE WHEN event_id % 5 = 0 THEN ', "speed": 1.5' ELSE '' END, ', "operator": ', event_id % 4, ', "late": null, "ok": true}')""",
    )
    for number, line in enumerate(loads):
        p.table("events").filter(F.col("event_id") % 2 == number).select(F.expr(line).alias("value")).write.text(f"{base}/landing{number}")
        load = files.read_landed(p.spark, f"{base}/landing{number}", contract)
        load.write.mode("append").parquet(f"{base}/bronze")
        ledger.learn(load)
    raw = files.read_table(p.spark, f"{base}/bronze")
    return ledger.promoted(raw).select("event_id", "operator", "speed", "code", "ok", F.size(files.UNDECLARED).cast("bigint").alias("left"))


@query
def q_gate_halves(p: Plant) -> DataFrame:
    """Both halves of the run gate, written in one pass and read back."""
    path = f"{work_folder(p.spark, 'halves')}/runs"
    runs = p.runs()
    gates.write_split(runs, gates.RUN_GATE, path)
    good = gates.read_half(p.spark, path, runs.schema, True).withColumn("is_valid", F.lit(True))
    return good.unionByName(gates.read_half(p.spark, path, runs.schema, False))


@query
def q_bronze_lineage(p: Plant) -> DataFrame:
    base = work_folder(p.spark, "lineage")
    p.raw_sensors().write.json(f"{base}/landing")
    landed = files.read_json(p.spark, f"{base}/landing", p.raw_sensors().schema)
    return landed.agg(
        F.count("*").alias("row_count"),
        F.count("_ingest_time").alias("with_time"),
        F.count_if(F.col("_source_file").contains(base.rsplit("/", 1)[-1])).alias("with_file"),
        F.count_distinct("machine_id").alias("machines"),
    )


# Fixed headers of the seed file.
SEED_HEADERS = [
    "UDI", "Product ID", "Type", "Air temperature [K]", "Process temperature [K]", "Rotational speed [rpm]",
    "Torque [Nm]", "Tool wear [min]", "Machine failure", "TWF", "HDF", "PWF", "OSF", "RNF",
]


def _seed_frame(p: Plant) -> DataFrame:
    """The events table in the shape of the seed file."""
    speed = F.get_json_object("props", "$.k").cast("bigint") + 1200
    return p.table("events").select(
        F.col("event_id").alias("udi"),
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("product_id"),
        F.when(F.col("event_id") % 3 == 0, "L").when(F.col("event_id") % 3 == 1, "M").otherwise("H").alias("type"),
        (F.lit(295.0) + F.col("event_id") % 10).alias("air_temp_k"),
        steady(F.lit(293.15) + F.col("value") / 10, 1).alias("process_temp_k"),
        speed.alias("rot_speed"),
        F.col("value").alias("torque"),
        (F.col("event_id") % 250).alias("tool_wear"),
        (F.col("event_type") == "error").cast("int").alias("machine_failure"),
        *[F.lit(0).alias(c) for c in ("twf", "hdf", "pwf", "osf", "rnf")],
    )


def _seed_file(p: Plant) -> str:
    path = f"{work_folder(p.spark, 'seed')}/csv"
    _seed_frame(p).toDF(*SEED_HEADERS).write.option("header", True).csv(path)
    return path


@query
def q_csv_seed_scan(p: Plant) -> DataFrame:
    seed = files.read_seed_csv(p.spark, _seed_file(p))
    # Inference picks int or bigint by the values; settle it, whatever the size of the data.
    return seed.withColumns({c: F.col(c).cast("bigint") for c in ("udi", "rot_speed", "tool_wear")})


@query
def q_seed_to_telemetry(p: Plant) -> DataFrame:
    seed = files.read_seed_csv(p.spark, _seed_file(p), names=None)
    nested = telemetry.seed_to_telemetry(
        seed, machine_id=F.col("UDI").cast("bigint"), reading_ts=F.lit("2024-01-01T00:00:00"), rnd=steady
    )
    flat = telemetry.flatten_readings(nested)
    return flat.select(
        "machine_id", "source", "temperature_c", "rotational_speed_rpm", "torque_nm", "tool_wear_min", "machine_failure"
    )


@query
def q_catalog_roundtrip(p: Plant) -> DataFrame:
    name = f"gold_oee_by_machine_{uuid.uuid4().hex[:12]}"
    catalog.overwrite(_mart(p), name, work_folder(p.spark, "catalog"))
    return p.spark.table(name).select("machine_id", "line", "avg_oee", "total_downtime_min")


@query
def q_stream_bronze(p: Plant) -> DataFrame:
    """Two landings and three ingest calls: every file is taken once."""
    base = work_folder(p.spark, "stream-bronze")
    events = p.table("events").select("event_id", F.col("user_id").alias("machine_id"), "event_type", "value")
    early = "coalesce(event_type IN ('view', 'click'), false)"
    for landing in (early, f"NOT {early}", None):
        if landing:
            events.filter(landing).write.mode("append").json(f"{base}/landing")
        stream = landed_json(p.spark, f"{base}/landing", events.schema)
        ingest_available(stream, f"{base}/table", f"{base}/checkpoint")
    return p.spark.read.parquet(f"{base}/table").select(*events.columns)


def _gated_stream(p: Plant) -> GatedTable:
    """Runs that land in two parts, each a micro-batch; the second is lost before its counts and comes again."""
    base = work_folder(p.spark, "stream-gate")
    runs = p.keyed_runs()
    table = GatedTable(p.spark, f"{base}/runs", StructType(runs.schema.fields))
    for landing in ("number % 3 = 0", "number % 3 <> 0"):
        runs.filter(landing).write.mode("append").parquet(f"{base}/landing")
        stream = p.spark.readStream.schema(runs.schema).parquet(f"{base}/landing")
        gate_available(stream, table, gates.RUN_GATE, f"{base}/checkpoint")
    files.delete_path(p.spark, f"{base}/runs/counts/batch=1")
    for _ in range(2):
        table.write(runs.filter("number % 3 <> 0"), gates.RUN_GATE, 1)
    return table


@query
def q_stream_gate(p: Plant) -> DataFrame:
    return _gated_stream(p).read()


@query
def q_stream_gate_audit(p: Plant) -> DataFrame:
    return _gated_stream(p).counts()


@query
def q_stream_upsert(p: Plant) -> DataFrame:
    """All orders land at revision 1, a part of them again at revision 3, and another part late at revision 2."""
    base = work_folder(p.spark, "stream-upsert")
    orders = p.table("orders").select(
        "o_orderkey", "o_orderstatus", F.lit(1).cast("bigint").alias("revision"), F.year("o_orderdate").alias("o_year")
    )

    def revised(rows: str, status: str, revision: int) -> DataFrame:
        return orders.filter(rows).withColumns({"o_orderstatus": F.lit(status), "revision": F.lit(revision).cast("bigint")})

    for landing in (orders, revised("o_orderkey % 4 = 0", "C", 3), revised("o_orderkey % 6 = 0", "L", 2)):
        landing.write.mode("append").json(f"{base}/landing")
        stream = landed_json(p.spark, f"{base}/landing", orders.schema, lineage=False)
        upsert_available(stream, f"{base}/orders", ["o_orderkey"], "o_year", f"{base}/checkpoint", ["revision"])
    return p.spark.read.schema(orders.schema).parquet(f"{base}/orders")


# --- percent ranks -----------------------------------------------------------


@query
def q_wear_percent_rank(p: Plant) -> DataFrame:
    wear = p.table("events").select(F.col("event_id").alias("udi"), (F.col("event_id") % 250).alias("tool_wear"))
    ranked = ordering.with_ranks(wear, "tool_wear", percent_rank="wear_pct")
    return ranked.withColumn("wear_pct", steady(F.col("wear_pct"), 6))


# --- scalar functions --------------------------------------------------------


@query
def q_fn_string(p: Plant) -> DataFrame:
    messy = F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))
    return p.table("orders").select(
        "o_orderkey",
        standard_code(messy).alias("code"),
        padded_id("M", F.col("o_custkey") % 50 + 1, 2).alias("machine_label"),
    )


@query
def q_fn_datetime(p: Plant) -> DataFrame:
    day = F.to_date("o_orderdate")
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return p.table("orders").select(
        "o_orderkey",
        day.alias("order_date"),
        F.date_sub(day, (F.col("o_orderkey") % 90).cast("int")).alias("earlier"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
        parsed_timestamp(text).cast("date").alias("parsed_day"),
        parsed_timestamp(F.when(F.col("o_orderkey") % 4 == 0, F.lit("not a time")).otherwise(text)).cast("date").alias("parsed_or_null"),
        F.date_diff(F.current_date(), F.date_sub(F.current_date(), (F.col("o_orderkey") % 9).cast("int"))).alias("days_back"),
    )


@query
def q_fn_math(p: Plant) -> DataFrame:
    part_null = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_quantity") / 10)
    return p.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        steady(F.col("l_extendedprice") / 7, 1).alias("round1"),
        steady(F.col("l_tax") * F.col("l_discount"), 3).alias("round3"),
        F.floor(F.col("l_extendedprice") / 100).alias("floored"),
        F.abs(F.col("l_quantity") - 25).alias("distance"),
        F.least(F.col("l_quantity") / 10, F.lit(1.0)).alias("capped"),
        F.least(part_null, F.lit(1.0)).alias("capped_null"),
        steady(1 - F.col("l_discount"), 2).alias("complement"),
        steady(kelvin_to_celsius(F.col("l_quantity") + 300), 2).alias("celsius"),
    )


@query
def q_fn_conditional(p: Plant) -> DataFrame:
    maybe = F.when(F.col("l_linenumber") % 2 != 0, F.col("l_tax") <= 0.05)
    return p.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "R", "returned")
        .when(F.col("l_linestatus") == "O", "open")
        .otherwise("closed")
        .alias("state"),
        F.when(F.col("l_quantity") > 40, 1).otherwise(F.when(F.col("l_tax") < 0.02, 1).otherwise(0)).alias("keep"),
        (F.col("l_returnflag").isin("A", "N") & ~(F.col("l_linenumber") != 1)).alias("first_kept"),
        F.coalesce(maybe, F.lit(False)).alias("gate"),
        F.lit(None).cast("date").alias("no_date"),
        F.col("l_linenumber").cast("string").alias("line_text"),
        (F.col("l_returnflag") == "R").cast("int").alias("flag_int"),
    )


# --- learning ----------------------------------------------------------------


@query
def q_class_balance(p: Plant) -> DataFrame:
    balance = learning.class_balance(p.learning_frame())
    return balance.withColumn("positive_rate", steady(F.col("positive_rate"), 6))


@query
def q_duplicate_audit(p: Plant) -> DataFrame:
    return learning.duplicate_audit(p.learning_frame().select("quantity", "discount", "tax", "size", "label"))


@query
def q_class_weights(p: Plant) -> DataFrame:
    weighted = learning.class_weights(p.learning_frame().select("label"))
    return weighted.groupBy("label").agg(
        F.count("*").alias("row_count"), steady(F.max("weight"), 6).alias("weight")
    )


@query
def q_stratified_split(p: Plant) -> DataFrame:
    frame = p.learning_frame().select(*LEARNING_KEYS, "label")
    return learning.stratified_parts(frame, "label", LEARNING_KEYS, [3, 1])


@query
def q_cv_folds(p: Plant) -> DataFrame:
    frame = p.learning_frame().select(*LEARNING_KEYS, "label")
    return learning.stratified_parts(frame, "label", LEARNING_KEYS, [1] * 5, part="fold")


def _rule_scored(p: Plant) -> DataFrame:
    """A score from two features, standing in for a model where figures must be checked."""
    score = F.col("quantity") + F.col("size")
    return p.learning_frame().select("label", score.alias("score"), (score > 50).cast("int").alias("prediction"))


@query
def q_confusion_metrics(p: Plant) -> DataFrame:
    figures = learning.confusion_metrics(_rule_scored(p))
    return figures.withColumns({c: steady(F.col(c), 6) for c in ("precision", "recall", "f1")})


@query
def q_auc(p: Plant) -> DataFrame:
    return learning.auc(_rule_scored(p), score="score").select(steady(F.col("auc"), 6).alias("auc"))


FOREST = learning.ForestParams()


def _trained(p: Plant) -> learning.TrainedForest:
    frame = stage(
        learning.training_frame(p.learning_frame(), LEARNING_FEATURES, "label", LEARNING_KEYS), "training"
    )
    return learning.train_and_score(frame, LEARNING_FEATURES, LEARNING_KEYS, FOREST)


@query
def q_permutation_importance(p: Plant) -> DataFrame:
    """What a score from two features loses if one of them is dealt to other rows; a feature it does not use loses nothing."""
    frame = learning.training_frame(p.learning_frame(), LEARNING_FEATURES, "label", LEARNING_KEYS)
    found = learning.permutation_importance(
        frame, ["quantity", "size", "tax"], LEARNING_KEYS, lambda df: df.withColumn("failure_probability", F.col("quantity") + F.col("size"))
    )
    return found.select("feature", steady(F.col("auc"), 6).alias("auc"), steady(F.col("drop"), 6).alias("auc_drop"))


@query
def q_ml_predictions(p: Plant) -> DataFrame:
    """Keys, labels, probabilities and classes of the test part."""
    return _trained(p).predictions.select(*LEARNING_KEYS, "label", "failure_probability", "prediction")


@query
def q_ml_importance(p: Plant) -> DataFrame:
    """Every feature with its importance in the forest and its place."""
    every = learning.importances(_trained(p).model, p.spark, LEARNING_FEATURES)
    return ordering.with_ranks(every, "importance", descending=True, rank="place")


@query
def q_ml_metrics(p: Plant) -> DataFrame:
    """Hold-out metrics and five-fold AUC, appended to a metrics table and read back."""
    return _logged_metrics(p)[0]


@query
def q_ml_prediction_checks(p: Plant) -> DataFrame:
    """Keys and labels of the test part, and whether each score is a share and each class the likelier one."""
    likelier = (F.col("failure_probability") > 0.5).cast("int")
    return _trained(p).predictions.select(
        *LEARNING_KEYS, "label", F.col("failure_probability").between(0, 1).alias("is_share"), (F.col("prediction") == likelier).alias("is_likelier")
    )


@query
def q_ml_importance_checks(p: Plant) -> DataFrame:
    """The three largest importances are cut from all; these must name every feature once and sum to one."""
    model = _trained(p).model
    every = learning.importances(model, p.spark, LEARNING_FEATURES)
    top = learning.importances(model, p.spark, LEARNING_FEATURES, top=3)
    whole = every.agg(F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"), steady(F.sum("importance"), 6).alias("total"), F.max("importance").alias("_most"))
    return top.agg(F.count("*").alias("in_top"), F.max("importance").alias("_top")).crossJoin(whole).select(
        "features", "total", "in_top", (F.col("_top") == F.col("_most")).alias("top_is_largest")
    )


def _logged_metrics(p: Plant) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The metrics table, the stored predictions and the stored scores of the folds."""
    trained = _trained(p)
    folds = learning.fold_scores(trained.train.unionByName(trained.test), LEARNING_FEATURES, LEARNING_KEYS, params=FOREST)
    scores = [learning.auc(folds.filter(F.col("fold") == k)).first()["auc"] for k in range(5)]
    base = work_folder(p.spark, "metrics")
    trained.predictions.write.parquet(f"{base}/predictions")
    stored = p.spark.read.parquet(f"{base}/predictions")
    learning.metrics_table(p.spark, "predictive_maintenance_rf", stored, scores).write.mode("append").parquet(f"{base}/ml_metrics")
    return p.spark.read.parquet(f"{base}/ml_metrics"), stored, folds


def _rank_auc(scored: DataFrame) -> DataFrame:
    """AUC from mean ranks of the positives."""
    n = scored.groupBy("failure_probability").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
    ranked = ordering.with_ranks(scored.select("failure_probability"), "failure_probability", rank="place").distinct().join(n, "failure_probability")
    total = ranked.agg(F.sum(F.col("pos") * (F.col("place") + (F.col("n") - 1) / 2)).alias("ranks"), F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"))
    return total.select(((F.col("ranks") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("q"))).alias("wanted"))


@query
def q_ml_metric_checks(p: Plant) -> DataFrame:
    """Whether every logged figure is there and comes out again, by other ways, from stored predictions and fold scores; and whether these vary."""
    known, stored, folds = _logged_metrics(p)
    again = stored.groupBy().agg(
        F.try_divide(F.sum(F.col("label") * F.col("prediction")), F.sum("prediction")).alias("precision"),
        F.try_divide(F.sum(F.col("label") * F.col("prediction")), F.sum("label")).alias("recall"),
        F.try_divide(2 * F.sum(F.col("label") * F.col("prediction")), F.sum("label") + F.sum("prediction")).alias("f1"),
    )
    wanted = again.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("wanted")) for m in ("precision", "recall", "f1")])))
    by_fold = reduce(DataFrame.unionByName, [_rank_auc(folds.filter(F.col("fold") == k)) for k in range(5)])
    cv = by_fold.agg(F.avg("wanted").alias("cv_auc_mean"), F.stddev_pop("wanted").alias("cv_auc_std"))
    wanted = wanted.unionByName(_rank_auc(stored).select(F.lit("test_auc").alias("metric"), "wanted")).unionByName(
        cv.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("wanted")) for m in ("cv_auc_mean", "cv_auc_std")])))
    )
    fits = F.coalesce(F.abs(F.col("value") - F.col("wanted")) < 1e-9, F.lit(False))
    checked = known.join(F.broadcast(wanted), "metric", "left").select("run_name", "metric", fits.alias("fits"))
    vary = stored.agg((F.count_distinct("failure_probability") > 10) & (F.count_distinct("prediction") == 2))
    return checked.unionByName(vary.select(F.lit("predictive_maintenance_rf").alias("run_name"), F.lit("predictions_vary").alias("metric"), F.col(vary.columns[0]).alias("fits")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
