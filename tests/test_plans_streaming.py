from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopfloor.__main__ import main
from shopfloor.operators import learning
from shopfloor.plans import medallion, prediction
from shopfloor.plans.warehouse import Warehouse
from shopfloor.sources import catalog
from shopfloor.streaming.ingest import ingest_available, landed_json
from shopfloor.streaming.upsert import upsert_available

MACHINES = [
    {"machine_id": f"M0{i}", "machine_name": f"n{i}", "line": "LINE-A" if i < 3 else "LINE-B", "machine_type": "CNC", "maintenance_tier": "standard", "install_date": "2019-03-12"}
    for i in range(1, 5)
]
PRODUCTS = [{"product_id": "P100", "product_name": "Bracket", "ideal_cycle_time_sec": 12.0}, {"product_id": "P200", "product_name": "Gear", "ideal_cycle_time_sec": 30.0}]


def _run(i, **changes):
    row = {
        "run_id": f"r{i}", "run_date": f"2024-01-0{1 + i % 5}", "machine_id": f"M0{1 + i % 3}", "product_id": "P100" if i % 2 else "P200", "shift": "night",
        "planned_production_min": 480, "downtime_min": 10 * (i % 7), "total_units": 500 + i, "good_units": 480 + i, "ingested_at": "2024-01-01T00:00:00+00:00",
    }
    return {**row, **changes}


def _write(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    _write(root / "mes/machines.json", MACHINES)
    _write(root / "mes/products.json", PRODUCTS)
    _write(root / "mes/runs_2024-01-01.json", [_run(i) for i in range(20)])
    _write(root / "mes/runs_2024-01-02.json", [_run(20, product_id=None), _run(21, total_units=-1), _run(22)])
    readings = {"temperature_c": 60.0, "vibration_mm_s": 2.5, "rotational_speed_rpm": 1500, "torque_nm": 40.0}
    sensor = {"machine_id": "M01", "reading_ts": "2024-01-01T00:00:00+00:00", "firmware": "v1.2", "source": "synthetic", "machine_failure": False}
    _write(root / "sensors/sensors_000.json", [{**sensor, "readings": readings}, {**sensor, "readings": {"temperature_c": 61.0}}])
    inspection = {"machine_id": "M01", "product_id": "P100", "inspected_ts": "2024-01-01T00:00:00+00:00", "defect_code": None, "inspector": "insp_A"}
    _write(root / "quality/quality_000.json", [{**inspection, "inspection_id": str(i), "result": r} for i, r in enumerate(["PASS", " fail ", "??"])])
    return root


def test_lake_end_to_end(spark, landing, tmp_path):
    lake = medallion.Lake(f"{tmp_path}/lake")
    assert medallion.bronze(spark, str(landing), lake) == {"dim_machines": 4, "dim_products": 2, "mes_runs": 23, "sensors": 2, "quality": 3}
    assert medallion.silver(spark, lake) == {
        "mes_runs": {"valid": 21, "quarantine": 2}, "sensors": {"valid": 1, "quarantine": 1}, "quality": {"valid": 2, "quarantine": 1},
    }
    assert medallion.silver_table(spark, lake, "mes_runs", quarantine=True).count() == 2
    assert medallion.machine_history(spark, lake, "2024-01-01") == 0
    written = medallion.gold(spark, lake)
    assert written == {"run_oee": 21, "gold_oee_by_machine": 3, "gold_oee_by_line": 2, "gold_machine_health": 4}
    health = {r["machine_id"]: r for r in lake.read(spark, "gold", "gold_machine_health").collect()}
    assert health["M01"]["fail_rate"] == 0.5 and health["M01"]["avg_tool_wear"] is None
    assert health["M04"]["avg_oee"] is None
    assert lake.read(spark, "silver", "run_oee").filter("oee < 0 OR oee > 1").count() == 0

    changed = [{**MACHINES[0], "maintenance_tier": "premium"}, *MACHINES[1:]]
    _write(landing / "mes/machines.json", changed)
    medallion.bronze(spark, str(landing), lake)
    assert medallion.machine_history(spark, lake, "2024-02-01") == 1
    table = lake.machine_history(spark)
    assert table.read().filter("machine_id = 'M01'").count() == 2 and table.read(0).count() == 4


def test_incremental_bronze(spark, landing, tmp_path):
    lake = medallion.Lake(f"{tmp_path}/lake")
    medallion.bronze_incremental(spark, str(landing), lake)
    assert lake.read(spark, "bronze", "mes_runs").count() == 23
    _write(landing / "mes/runs_2024-01-03.json", [_run(23)])
    for _ in range(2):
        medallion.bronze_incremental(spark, str(landing), lake)
        assert lake.read(spark, "bronze", "mes_runs").count() == 24
        assert lake.read(spark, "bronze", "dim_machines").count() == 4
    assert medallion.silver(spark, lake)["mes_runs"] == {"valid": 22, "quarantine": 2}


def test_daily_refresh(spark, landing, tmp_path, rows):
    """Two days of files, the second with a late run, a corrected one that moves, and one that fails the gate."""
    lake, whole = medallion.Lake(f"{tmp_path}/lake"), medallion.Lake(f"{tmp_path}/whole")
    assert medallion.refresh(spark, str(landing), lake)["gold_oee_by_machine"] == 3
    later = "2024-01-09T00:00:00+00:00"
    _write(landing / "mes/runs_2024-01-03.json", [_run(30), _run(3, run_date="2024-01-07", downtime_min=99, ingested_at=later), _run(31, good_units=-1)])
    for _ in range(2):
        medallion.refresh(spark, str(landing), lake)
        counts = medallion.gated_table(spark, lake, "mes_runs").counts().orderBy("batch").collect()
        assert [(r.valid, r.quarantine) for r in counts] == [(21, 2), (2, 1)]
    facts = medallion.incremental_gold(spark, lake).facts()
    assert facts.count() == 22 and [str(r.run_date) for r in facts.filter("run_id = 'r3'").collect()] == ["2024-01-07"]
    # The same as a full build without the run that was replaced.
    (landing / "mes/runs_2024-01-01.json").write_text("".join(json.dumps(_run(i)) + "\n" for i in range(20) if i != 3))
    medallion.bronze(spark, str(landing), whole)
    medallion.silver(spark, whole)
    medallion.machine_history(spark, whole, "2024-01-01")
    medallion.gold(spark, whole)
    for mart in ("gold_oee_by_machine", "gold_oee_by_line"):
        full = whole.read(spark, "gold", mart)
        assert rows(lake.read(spark, "gold", mart), *full.columns) == rows(full)


def test_catalog_command(spark, landing, tmp_path, monkeypatch):
    _write(landing / "downtime/d.json", [{"event_id": 1, "event_date": "2024-01-01", "machine_id": "M01", "reason": "Breakdown", "loss_category": "Availability", "planned_type": "Unplanned", "duration_min": 30}])
    try:
        main(["catalog", "--landing", str(landing), "--schema", "plant_command_test", "--location", f"{tmp_path}/wh", "--effective", "2024-01-01"])
        assert spark.table("silver_mes_runs").count() == 21 and spark.table("silver_mes_runs_quarantine").count() == 2
        assert spark.table("gold_loss_taxonomy").count() == 1 and spark.table("dim_machine_scd2").count() == 4
        assert spark.table("gold_machine_health").count() > 0
    finally:
        catalog.use(spark, "default")
        spark.sql("DROP SCHEMA plant_command_test CASCADE")


def test_command_line(spark, landing, tmp_path, capsys, monkeypatch):
    main(["all", "--landing", str(landing), "--lake", f"{tmp_path}/lake", "--effective", "2024-01-01", "--infer"])
    out = capsys.readouterr().out
    assert "'mes_runs': 23" in out and "'gold_machine_health': 4" in out
    with pytest.raises(SystemExit):
        main(["bronze", "--lake", f"{tmp_path}/lake"])


def test_warehouse_end_to_end(spark, tmp_path):
    catalog.use(spark, "plant_tables_test")
    try:
        store = Warehouse(spark, f"{tmp_path}/wh")
        machines = spark.createDataFrame(
            [("M01", "a", "LINE-A", "CNC", 9, "standard"), ("M02", "b", "LINE-B", "CNC", 18, "standard")],
            "machine_id string, machine_name string, line string, machine_type string, age_years bigint, maintenance_tier string",
        )
        products = spark.createDataFrame([("P100", 12.0)], "product_id string, ideal_cycle_time_sec double")
        runs = spark.createDataFrame(
            [(date(2024, 1, 1 + i), f"M0{1 + i % 2}", "P100" if i else None, "night", 480, 10, 500, 480, 0) for i in range(9)],
            "run_date date, machine_id string, product_id string, shift string, planned_min bigint, downtime_min bigint, total_units bigint, good_units bigint, startup_scrap bigint",
        )
        events = spark.createDataFrame(
            [(1, "Breakdown", "Availability", "Unplanned", 30), (2, "Minor Stop", "Performance", "Unplanned", 10)],
            "event_id int, reason string, loss_category string, planned_type string, duration_min bigint",
        )
        sensors = spark.createDataFrame([("M01", 60.0, 10, 1)], "machine_id string, temperature_c double, tool_wear_min int, machine_failure int")
        quality = spark.createDataFrame([("M01", "FAIL"), ("M01", "PASS"), ("M02", "PASS")], "machine_id string, result string")
        store.reset()
        store.bronze(machines, products, runs, events, sensors, quality)
        store.silver()
        store.gold()
        assert spark.table("silver_mes_runs").count() == 8 and spark.table("silver_mes_runs_quarantine").count() == 1
        assert spark.table("gold_daily_oee").columns == ["machine_id", "run_date", "daily_oee", "downtime_min", "rolling_7d_oee"]
        assert spark.table("gold_downtime_pareto").orderBy("cumulative_pct").collect()[-1]["cumulative_pct"] == 100.0
        risks = {r["machine_id"]: r for r in spark.table("gold_failure_risk").collect()}
        assert risks["M01"]["fail_rate"] == 0.5 and risks["M01"]["failure_risk"] is not None

        updates = machines.withColumn("maintenance_tier", F.when(F.col("machine_id") == "M01", "premium").otherwise(F.col("maintenance_tier")))
        for _ in range(2):  # the second run on the same day changes nothing
            dim = store.machine_history(updates, "2024-02-01")
            assert [tuple(r) for r in dim.select("machine_id", "maintenance_tier", "is_current").orderBy("machine_id", "is_current").collect()] == [
                ("M01", "standard", False), ("M01", "premium", True), ("M02", "standard", True),
            ]
        store.reset()
        assert not catalog.exists(spark, "gold_failure_risk")
    finally:
        catalog.use(spark, "default")
        spark.sql("DROP SCHEMA plant_tables_test CASCADE")


def test_prediction_report(spark, tmp_path):
    lines = ["UDI,Product ID,Type,Air,Process,Speed,Torque,Wear,Machine failure,TWF,HDF,PWF,OSF,RNF"]
    lines += [f"{i},M{i},L,{298 + i % 3},{308 + i % 5},{1400 + i},{30 + i % 20},{i % 240},{int(i % 240 > 200)},0,0,0,0,0" for i in range(480)]
    (tmp_path / "seed.csv").write_text("\n".join(lines) + "\n")
    report = prediction.predict_failures(spark, f"{tmp_path}/seed.csv", f"{tmp_path}/metrics", learning.ForestParams(trees=5, depth=4), folds=2)
    assert report.balance.first()["row_count"] == 480 and report.importances.count() == 5
    logged = {r["metric"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/metrics").collect()}
    assert logged["test_auc"] > 0.9 and report.predictions.count() == 121


def test_each_file_is_ingested_once(spark, tmp_path):
    def ingest():
        stream = landed_json(spark, f"{tmp_path}/landing", "id bigint", glob_filter="*.json")
        ingest_available(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint")
        return sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/table").collect())

    _write(tmp_path / "landing/a.json", [{"id": 1}, {"id": 2}])
    _write(tmp_path / "landing/skip.txt", [{"id": 9}])
    assert ingest() == [1, 2]
    assert ingest() == [1, 2]
    _write(tmp_path / "landing/b.json", [{"id": 3}])
    assert ingest() == [1, 2, 3]
    stamped = spark.read.parquet(f"{tmp_path}/table")
    assert stamped.filter("_source_file IS NULL OR _ingest_time IS NULL").count() == 0


def test_streamed_upserts(spark, tmp_path, rows):
    schema = "k bigint, v string, seq bigint, day string"

    def upsert():
        stream = landed_json(spark, f"{tmp_path}/landing", schema, lineage=False)
        upsert_available(stream, f"{tmp_path}/table", ["k"], "day", f"{tmp_path}/checkpoint", ["seq"])
        return rows(spark.read.schema(schema).parquet(f"{tmp_path}/table"), "k", "v")

    _write(tmp_path / "landing/a.json", [{"k": 1, "v": "a", "seq": 1, "day": "d1"}, {"k": 1, "v": "b", "seq": 2, "day": "d1"}, {"k": 2, "v": "c", "seq": 1, "day": "d2"}])
    assert upsert() == [(1, "b"), (2, "c")]
    _write(tmp_path / "landing/b.json", [{"k": 2, "v": "d", "seq": 3, "day": "d2"}, {"k": 3, "v": "e", "seq": 3, "day": "d3"}])
    assert upsert() == [(1, "b"), (2, "d"), (3, "e")]
    assert upsert() == [(1, "b"), (2, "d"), (3, "e")]
