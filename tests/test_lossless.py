"""Rows that earlier versions lost, doubled or missed."""

from __future__ import annotations

import json
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import gates, history, joins, losses, merge
from shopfloor.plans import medallion
from shopfloor.plans.warehouse import Warehouse, merge_tiers
from shopfloor.session import drop_staged, stage, work_folder
from shopfloor.sources import files


def _facts(spark, rows):
    return spark.createDataFrame(rows, "id long, year int, revision int")


def _upsert(spark, base, *batches, order=None):
    for number, rows in enumerate(batches):
        merge.upsert_partitions(f"{base}/facts", _facts(spark, rows), ["id"], "year", number, f"{base}/log", order)
    return sorted((tuple(r) for r in spark.read.schema("id long, revision int, year int").parquet(f"{base}/facts").select("id", "year", "revision").collect()), key=str)


@pytest.mark.parametrize("listed", [10_000, 0])
def test_rows_of_a_null_partition_stay(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(merge, "LISTED_PARTITIONS", listed)
    got = _upsert(spark, str(tmp_path), [(1, None, 0), (2, None, 0), (3, 1, 0)], [(1, None, 1), (4, 1, 1)])
    assert got == [(1, None, 1), (2, None, 0), (3, 1, 0), (4, 1, 1)]


def test_a_moved_key_leaves_its_old_partition(spark, tmp_path):
    got = _upsert(spark, str(tmp_path), [(1, 1, 0), (2, 2, 0), (3, 2, 0), (5, None, 0)], [(1, 2, 1), (2, None, 1), (5, 7, 1)])
    assert got == [(1, 2, 1), (2, None, 1), (3, 2, 0), (5, 7, 1)]


def test_an_older_revision_never_wins(spark, tmp_path):
    got = _upsert(spark, str(tmp_path), [(1, 1, 2), (2, 1, 2)], [(1, 3, 1), (2, 1, 3)], order=["revision"])
    assert got == [(1, 1, 2), (2, 1, 3)]


def test_a_replayed_batch_and_repeated_keys(spark, tmp_path):
    base = str(tmp_path)
    rows = _upsert(spark, base, [(1, 1, 0)], [(1, 1, 1)])
    merge.upsert_partitions(f"{base}/facts", _facts(spark, [(1, 1, 9)]), ["id"], "year", 1, f"{base}/log")
    assert _upsert(spark, base) == rows == [(1, 1, 1)]
    with pytest.raises(ValueError):
        merge.upsert_partitions(f"{base}/facts", _facts(spark, [(1, 1, 9), (1, 2, 9)]), ["id"], "year", 2, f"{base}/log")


def test_merge_refuses_two_source_rows_and_keeps_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError):
        merge.merge_df(target, twice, ["k"], update={"v": F.col("s.v")})
    source = spark.createDataFrame([(1, "x"), (None, "m"), (None, "l"), (2, "z")], "k int, v string")
    got = merge.merge_df(target, source, ["k"], update={"v": F.col("s.v")}, insert=True).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "x"), (None, "n"), (None, "m"), (None, "l"), (2, "z")]))


def _machines(spark, *rows):
    return spark.createDataFrame([*rows], "machine_id string, line string, maintenance_tier string")


def test_history_refuses_null_keys_and_back_dated_changes(spark):
    opened = history.open_history(_machines(spark, ("M1", "A", "basic")), "2024-02-01")
    with pytest.raises(ValueError):
        history.apply_snapshot(opened, _machines(spark, (None, "A", "basic")), "2024-03-01")
    with pytest.raises(Exception, match="change before"):
        history.apply_snapshot(opened, _machines(spark, ("M1", "A", "premium")), "2024-01-01").collect()
    same_day = history.apply_snapshot(opened, _machines(spark, ("M1", "A", "premium")), "2024-02-01").collect()
    assert [(r.maintenance_tier, r.is_current, r.valid_to) for r in same_day] == [("premium", True, None)]


def test_a_version_without_a_flag_is_history(spark):
    opened = history.open_history(_machines(spark, ("M1", "A", "basic")), "2024-01-01")
    unknown = opened.withColumn("is_current", F.lit(None).cast("boolean"))
    got = history.apply_snapshot(unknown, _machines(spark, ("M1", "A", "gold")), "2024-02-01").collect()
    assert sorted((r.maintenance_tier, str(r.is_current)) for r in got) == [("basic", "None"), ("gold", "True")]


def test_two_changes_in_a_day_leave_one_current_version(spark, tmp_path):
    store, name = Warehouse(spark, str(tmp_path)), f"dim_{uuid.uuid4().hex[:8]}"
    store.save(history.open_history(_machines(spark, ("M1", "A", None), ("M2", "A", "basic")), "2024-01-01"), name)
    for tier in ("premium", "gold", "gold"):
        merge_tiers(store, name, _machines(spark, ("M1", "A", tier)), "2024-02-01")
    got = [(r.machine_id, r.maintenance_tier, r.is_current, r.valid_to) for r in spark.table(name).orderBy("machine_id", "valid_from", "is_current").collect()]
    day = date(2024, 2, 1)
    assert got == [("M1", None, False, day), ("M1", "premium", False, day), ("M1", "gold", True, None), ("M2", "basic", True, None)]
    with pytest.raises(ValueError):
        merge_tiers(store, name, _machines(spark, ("M1", "A", "x"), ("M1", "A", "y")), "2024-03-01")


def test_bronze_keeps_what_the_contract_has_no_place_for(spark, tmp_path):
    lines = ['{"id": 1, "r": {"t": 2.5, "hum": 7}, "who": "x"}', '{"id": "12a", "r": {"t": 1}}', "no json", "", '{"id": 3}']
    (tmp_path / "a.json").write_text("\n".join(lines))
    contract = spark.createDataFrame([], "id long, r struct<t: double>").schema
    got = files.read_landed(spark, str(tmp_path), contract).collect()
    assert [r.id for r in got] == [1, None, None, 3]
    assert [r._corrupt_record for r in got] == [None, lines[1], "no json", None]
    assert [r._undeclared for r in got] == [{"who": "x", "r.hum": "7"}, {}, {}, {}] and got[1].r.t == 1.0


def test_an_edited_machine_file_reaches_history(spark, tmp_path):
    landing, lake = tmp_path / "landing", medallion.Lake(f"{tmp_path}/lake")
    for folder, name, row in (("mes", "products.json", {"product_id": "P"}), ("mes", "runs_1.json", {"run_id": "r"}), ("sensors", "s.json", {"machine_id": "M1"}), ("quality", "q.json", {"inspection_id": "i"})):
        (landing / folder).mkdir(parents=True, exist_ok=True)
        (landing / folder / name).write_text(json.dumps(row))
    for tier, day in (("basic", "2024-01-01"), ("premium", "2024-02-01")):
        (landing / "mes/machines.json").write_text(json.dumps({"machine_id": "M1", "line": "A", "maintenance_tier": tier}))
        medallion.bronze_incremental(spark, str(landing), lake)
        medallion.machine_history(spark, lake, day)
    rows = lake.machine_history(spark).read().orderBy("valid_from").collect()
    assert [(r.maintenance_tier, r.is_current) for r in rows] == [("basic", False), ("premium", True)]
    assert lake.read(spark, "bronze", "mes_runs").count() == 1


def test_gates_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("M", "P", 2, 1)], "machine_id string, product_id string, total_units int, good_units int").write.parquet(f"{tmp_path}/runs")
    plan = gates.accepted(spark.read.parquet(f"{tmp_path}/runs"), gates.RUN_GATE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(total_units)" in plan


def test_a_reason_without_minutes_keeps_the_running_share(spark):
    events = spark.createDataFrame([("a", 3), ("b", 1), ("c", None)], "reason string, duration_min int")
    got = {r.reason: r.cumulative_pct for r in losses.pareto(events).collect()}
    assert got == {"a": 75.0, "b": 100.0, "c": 100.0}


def test_wide_lookups_are_not_broadcast(spark, monkeypatch):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k int, v string")
    assert joins.fits(wide)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10_000)
    assert not joins.fits(wide)
    facts = spark.createDataFrame([(i % 60,) for i in range(600)] + [(None,)], "k int")
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    got = joins.lookup_join(facts, wide, ["k"], hot_share=1 / 10)
    assert got.count() == 601 and got.where("v IS NULL").count() == 101


def test_many_lookup_rows_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    facts = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3, "k int")
    lookup = spark.createDataFrame([(1, i) for i in range(9)] + [(2, 0)], "k int, v int")
    assert joins.lookup_join(facts, lookup, ["k"]).count() == 453


def test_staged_folders_can_be_dropped(spark):
    staged = stage(spark.range(3))
    assert staged.count() == 3 and drop_staged(spark) > 0 and drop_staged(spark) == 0
    assert not files.path_exists(spark, work_folder(spark, "none"))
