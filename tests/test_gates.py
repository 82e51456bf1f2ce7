from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from shopfloor.functions.cleaning import parsed_timestamp, standard_code
from shopfloor.operators import gates

RUN = "machine_id string, product_id string, total_units bigint, good_units bigint"
RUN_ROWS = [
    ("M01", "P100", 10, 9),
    (None, "P100", 10, 9),
    ("M01", None, 10, 9),
    ("M01", "P100", -1, 9),
    ("M01", "P100", 0, 0),
    ("M01", "P100", 10, 11),
    ("M01", "P100", 10, -1),
    ("M01", "P100", None, 9),
    ("M01", "P100", 10, None),
]


def test_every_row_lands_on_one_side(spark):
    df = spark.createDataFrame(RUN_ROWS, RUN)
    for gate in (gates.RUN_GATE, gates.RUN_GATE_BASIC):
        good, bad = gates.split(df, gate)
        assert good.count() + bad.count() == df.count()
    assert gates.accepted(df, gates.RUN_GATE).count() == 1
    assert gates.accepted(df, gates.RUN_GATE_BASIC).count() == 3  # without machine, and good < 0, pass too


def test_quarantine_keeps_flag_and_reasons(spark):
    df = spark.createDataFrame(RUN_ROWS, RUN)
    good, bad = gates.split(df, gates.RUN_GATE)
    assert "is_valid" not in good.columns
    assert [r[0] for r in bad.select("is_valid").distinct().collect()] == [False]
    explained = gates.quarantined(df, gates.RUN_GATE, reasons=True)
    by_rule = {tuple(r["_reason"]) for r in explained.collect()}
    assert ("machine",) in by_rule and ("product",) in by_rule
    assert ("total_positive", "good_within_total") in by_rule  # total_units is NULL


def test_one_pass_write_counts_and_reads_back(spark, tmp_path, rows):
    df = spark.createDataFrame(RUN_ROWS, RUN)
    counts = gates.write_split(df, gates.RUN_GATE, f"{tmp_path}/runs")
    assert counts == {"valid": 1, "quarantine": 8}
    good = gates.read_half(spark, f"{tmp_path}/runs", df.schema, True)
    bad = gates.read_half(spark, f"{tmp_path}/runs", df.schema, False)
    assert good.columns == df.columns and rows(good) == [RUN_ROWS[0]]
    assert bad.columns == [*df.columns, "is_valid"] and rows(bad.drop("is_valid")) == rows(df.filter("good_units IS NULL OR NOT (total_units = 10 AND good_units = 9 AND machine_id = 'M01' AND product_id = 'P100') OR machine_id IS NULL OR product_id IS NULL OR total_units IS NULL"))


def test_absent_half_is_empty(spark, tmp_path):
    df = spark.createDataFrame(RUN_ROWS[:1], RUN)
    assert gates.write_split(df, gates.RUN_GATE, f"{tmp_path}/runs") == {"valid": 1, "quarantine": 0}
    assert gates.read_half(spark, f"{tmp_path}/runs", df.schema, False).count() == 0


def test_quality_gate_ignores_defect_code(spark):
    df = spark.createDataFrame(
        [(1, "M01", " fail ", None), (2, "M01", "pass", "DENT"), (3, "M01", "unknown", None), (4, "M01", None, None), (5, None, "PASS", None)],
        "inspection_id bigint, machine_id string, result string, defect_code string",
    ).withColumn("result", standard_code(F.col("result")))
    assert sorted(r["inspection_id"] for r in gates.accepted(df, gates.QUALITY_GATE).collect()) == [1, 2]


def test_sensor_gate(spark):
    df = spark.createDataFrame(
        [("M01", 1200, 40.0), (None, 1200, 40.0), ("M01", None, 40.0), ("M01", 1200, None)],
        "machine_id string, rotational_speed_rpm bigint, torque_nm double",
    )
    assert gates.accepted(df, gates.SENSOR_GATE).count() == 1


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00",), ("nonsense",), (None,)], "t string")
    got = [r[0] for r in df.select(parsed_timestamp(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [datetime.datetime(2024, 1, 1, 8), datetime.datetime(2024, 1, 1, 10), None, None]


def test_audit(spark, rows):
    df = spark.createDataFrame(RUN_ROWS, RUN)
    assert rows(gates.audit({"mes_runs": (df, gates.RUN_GATE)})) == [("mes_runs", "quarantine", 8), ("mes_runs", "valid", 1)]
