from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shopfloor.functions.rounding import half_up, steady
from shopfloor.operators import health, losses, marts

RUN = (
    "run_date date, machine_id string, product_id string, shift string, planned_production_min bigint, downtime_min bigint,"
    " total_units bigint, good_units bigint"
)
DAY = date(2024, 1, 1)


@pytest.fixture
def products(spark):
    return spark.createDataFrame([("P1", 12.0), ("P2", 60.0)], "product_id string, ideal_cycle_time_sec double")


@pytest.fixture
def machines(spark):
    return spark.createDataFrame(
        [("M1", "one", "A", "CNC", 9), ("M2", "two", "A", "Press", 18), ("M3", "three", "B", "CNC", 1)],
        "machine_id string, machine_name string, line string, machine_type string, age_years int",
    )


def runs(spark, *made):
    return spark.createDataFrame(list(made), RUN)


def test_run_oee_formula(spark, products):
    r = marts.run_oee(runs(spark, (DAY, "M1", "P1", "night", 480, 80, 1000, 900)), products).first()
    assert r["run_time_min"] == 400 and r["scrap_units"] == 100
    assert r["availability"] == pytest.approx(400 / 480)
    assert r["performance"] == pytest.approx(12 * 1000 / (400 * 60))
    assert r["quality"] == pytest.approx(0.9)
    assert r["oee"] == pytest.approx(r["availability"] * r["performance"] * r["quality"])


def test_performance_is_capped(spark, products):
    r = marts.run_oee(runs(spark, (DAY, "M1", "P2", "night", 480, 400, 1000, 900)), products).first()
    assert r["performance"] == 1.0 and 0 <= r["oee"] <= 1


def test_unknown_product_scores_one_unless_strict(spark, products):
    run = runs(spark, (DAY, "M1", "P9", "night", 480, 80, 1000, 900))
    assert marts.run_oee(run, products).first()["performance"] == 1.0
    assert marts.run_oee(run, products, strict=True).first()["performance"] is None


def test_no_division_error_when_the_machine_never_ran(spark, products):
    r = marts.run_oee(runs(spark, (DAY, "M1", "P1", "night", 480, 480, 10, 9)), products).first()
    assert r["availability"] == 0 and r["performance"] == 1.0 and r["oee"] == 0


def test_other_planned_column(spark, products):
    run = runs(spark, (DAY, "M1", "P1", "night", 480, 80, 1000, 900)).withColumnRenamed("planned_production_min", "planned_min")
    assert marts.run_oee(run, products, "planned_min").first()["run_time_min"] == 400


@pytest.fixture
def oee(spark, products):
    return marts.run_oee(
        runs(
            spark,
            (DAY, "M1", "P1", "morning", 480, 80, 1000, 900),
            (DAY, "M1", "P1", "night", 480, 240, 100, 100),
            (DAY + timedelta(1), "M2", "P1", "night", 480, 0, 1200, 600),
            (DAY + timedelta(1), "M9", "P1", "night", 480, 0, 1200, 600),
        ),
        products,
    )


def test_mart_averages_runs_but_scrap_is_a_ratio_of_sums(oee, machines):
    m1 = marts.oee_by_machine(oee, machines).filter("machine_id = 'M1'").first()
    assert m1["avg_quality"] == 0.95 and m1["scrap_rate"] == 0.091
    assert (m1["total_downtime_min"], m1["total_units"], m1["total_scrap"]) == (320, 1100, 100)
    assert m1["line"] == "A"


def test_mart_keeps_machines_without_dimension_row(oee, machines):
    assert marts.oee_by_machine(oee, machines).filter("machine_id = 'M9'").first()["line"] is None
    assert marts.oee_by_machine_basic(oee, machines).filter("machine_id = 'M1'").first()["age_years"] == 9


def test_line_mean_is_over_runs(oee, machines):
    by_line = {r["line"]: r for r in marts.oee_by_line(oee, machines).collect()}
    expected = oee.filter("machine_id IN ('M1', 'M2')").agg(F.round(F.avg("oee"), 3)).first()[0]
    assert by_line["A"]["avg_oee"] == expected and by_line["A"]["total_units"] == 2300
    assert None in by_line and "B" not in by_line


def test_dashboard_line_mean_is_over_machines(spark):
    mart = spark.createDataFrame([("M1", "A", 0.2), ("M2", "A", 0.4), ("M3", "B", 0.9)], "machine_id string, line string, avg_oee double")
    assert {r["line"]: r["avg_machine_oee"] for r in marts.dashboard_oee_by_line(mart).collect()} == {"A": 0.3, "B": 0.9}
    assert marts.overall_oee(mart).first()["overall_oee"] == 0.5


def _daily(spark, *points):
    return spark.createDataFrame([("M1", d, v, 10) for d, v in points], "machine_id string, run_date date, daily_oee double, downtime_min bigint")


def test_rolling_counts_rows_or_days(spark):
    daily = _daily(spark, (DAY, 0.1), (DAY + timedelta(10), 0.5))
    by_rows = {r["run_date"]: r["rolling_7d_oee"] for r in marts.rolling_oee(daily).collect()}
    by_days = {r["run_date"]: r["rolling_7d_oee"] for r in marts.rolling_oee(daily, calendar=True).collect()}
    assert by_rows[DAY + timedelta(10)] == 0.3 and by_days[DAY + timedelta(10)] == 0.5


def test_rolling_window_is_seven_wide(spark):
    daily = _daily(spark, *[(DAY + timedelta(i), float(i)) for i in range(10)])
    last = {r["run_date"]: r["rolling_7d_oee"] for r in marts.rolling_oee(daily).collect()}[DAY + timedelta(9)]
    assert last == 6.0


def test_week_year_choice(spark):
    daily = _daily(spark, (date(2024, 12, 30), 0.4))
    assert tuple(marts.weekly_oee(daily).first())[:2] == (2024, 1)
    assert tuple(marts.weekly_oee(daily, iso_year=True).first())[:2] == (2025, 1)


def test_running_downtime(spark):
    daily = _daily(spark, *[(DAY + timedelta(i), 0.5) for i in range(4)])
    assert sorted(r["running_downtime_min"] for r in marts.running_downtime(daily).collect()) == [10, 20, 30, 40]


def test_shift_has_no_quality_column(oee):
    assert marts.shift_performance(oee).columns == ["shift", "oee", "availability", "performance"]


def test_rank_in_line(spark, rows):
    mart = spark.createDataFrame(
        [("M1", "A", 0.5), ("M2", "A", 0.7), ("M3", "A", 0.5), ("M4", "A", 0.1), ("M5", "B", 0.1), ("M6", None, 0.3)],
        "machine_id string, line string, avg_oee double",
    )
    assert rows(marts.rank_in_line(mart), "machine_id", "line_rank", "line_dense_rank") == [
        ("M1", 2, 2), ("M2", 1, 1), ("M3", 2, 2), ("M4", 4, 3), ("M5", 1, 1), ("M6", 1, 1),
    ]


def test_pareto_shares_and_ties(spark):
    events = spark.createDataFrame([("b", 30), ("a", 30), ("c", 40), ("c", 0)], "reason string, duration_min bigint")
    got = [tuple(r) for r in losses.pareto(events).orderBy(F.desc("total_min"), "reason").collect()]
    assert got == [("c", 40, 2, 40.0, 40.0), ("a", 30, 1, 30.0, 70.0), ("b", 30, 1, 30.0, 100.0)]


def test_taxonomy(spark, rows):
    events = spark.createDataFrame([("Breakdown", 10), ("Minor Stop", 5), ("Material Starvation", 1)], "reason string, duration_min bigint")
    known = losses.categorise(events)
    assert rows(losses.loss_taxonomy(known)) == [("Availability", "Unplanned", 11, 2), ("Performance", "Unplanned", 5, 1)]
    assert rows(losses.downtime_by_category(known)) == [("Availability", 11, 2), ("Performance", 5, 1)]
    assert losses.taxonomy(spark).count() == 6


def test_health_starts_from_the_machines(spark, machines, oee):
    sensors = spark.createDataFrame(
        [("M1", 60.0, 10, True), ("M1", 70.04, 20, False), ("M8", 1.0, 1, True)],
        "machine_id string, temperature_c double, tool_wear_min bigint, machine_failure boolean",
    )
    quality = spark.createDataFrame([("M1", "PASS"), ("M1", "FAIL"), ("M1", "PASS")], "machine_id string, result string")
    got = {r["machine_id"]: r for r in health.machine_health(machines, marts.oee_by_machine(oee, machines), sensors, quality).collect()}
    assert set(got) == {"M1", "M2", "M3"}
    m1 = got["M1"]
    assert (m1["avg_temp_c"], m1["max_temp_c"], m1["avg_tool_wear"], m1["sensor_failures"]) == (65.0, 70.0, 15.0, 1)
    assert (m1["inspections"], m1["fail_rate"]) == (3, 0.333)
    assert got["M3"]["avg_oee"] is None and got["M3"]["inspections"] is None
    basic = health.machine_health_basic(marts.oee_by_machine_basic(oee, machines), sensors, quality)
    assert {r["machine_id"] for r in basic.collect()} == {"M1", "M2", "M9"}


def test_risk_is_null_with_a_null_input(spark):
    h = spark.createDataFrame(
        [("M1", "A", 9, 0.5, 0.1, 10), ("M2", "A", 9, None, 0.1, 10), ("M3", "A", 18, 0.5, None, 10), ("M4", "A", 18, 0.5, 0.1, 10)],
        "machine_id string, line string, age_years int, oee double, fail_rate double, total_downtime_min bigint",
    )
    risk = health.failure_risk(h)
    assert {r["machine_id"]: r["failure_risk"] for r in risk.collect()} == {"M1": 0.42, "M2": None, "M3": None, "M4": 0.57}
    assert [r["machine_id"] for r in health.top_risk(risk, 2).collect()] == ["M4", "M1"]


def test_correlation_leaves_nulls_out(spark):
    h = spark.createDataFrame(
        [(0.1, 0.1, 0.3), (0.2, 0.2, 0.2), (0.3, 0.3, 0.1), (0.9, None, None)], "oee double, scrap_rate double, fail_rate double"
    )
    assert tuple(health.kpi_correlation(h).first()) == (1.0, -1.0)


def test_rounding(spark):
    df = spark.createDataFrame([(1.0005,), (0.2345,), (-0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 3)).collect()] == [1.001, 0.235, -0.5, None]
    assert [r[0] for r in df.select(steady(F.col("x"), 3)).collect()] == [1.001, 0.235, -0.5, None]
