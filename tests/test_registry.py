from __future__ import annotations

import pytest

import __spark_entry__ as entry
from shopfloor.operators import joins
from shopfloor.plans import registry
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Values that a forest makes; further queries check them, and have SQL.
VALUES = {"q_ml_predictions", "q_ml_importance", "q_ml_metrics"}


def test_every_query_has_sql():
    assert set(registry.queries()) - VALUES == set(registry.oracle_sql()) and VALUES < set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_values_of_the_forest(spark):
    made = {name: registry.queries()[name](spark, SF_DIR).collect() for name in sorted(VALUES)}
    assert len({r.failure_probability for r in made["q_ml_predictions"]}) > 10
    assert all(0 <= r.failure_probability <= 1 and r.prediction == int(r.failure_probability > 0.5) for r in made["q_ml_predictions"])
    assert sorted(r.place for r in made["q_ml_importance"]) == [1, 2, 3, 4, 5] and abs(sum(r.importance for r in made["q_ml_importance"]) - 1) < 1e-9
    metrics = {r.metric: r.value for r in made["q_ml_metrics"]}
    assert len(metrics) == 6 and all(0 <= v <= 1 for v in metrics.values())


LARGE_LOOKUPS = ["q_run_oee", "q_rank_in_line", "q_wear_percent_rank", "q_scd2_as_of", "q_fact_upsert", "q_stratified_split"]


@pytest.mark.parametrize("name", LARGE_LOOKUPS)
def test_query_agrees_when_no_lookup_may_be_broadcast(spark, con, monkeypatch, name):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(joins, "HOT_SHARE", 1 / 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "machine_id" and df.count() > 0
