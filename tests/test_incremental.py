"""Incremental gold, observed history, the merged as-of join and streamed gates."""

from __future__ import annotations

import random
from datetime import date, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from shopfloor.functions.rounding import steady
from shopfloor.operators import gates, history, increments, marts
from shopfloor.plans.refresh import IncrementalGold
from shopfloor.streaming.gates import GatedTable, gate_available

D = date(2024, 1, 1)
RUNS = "run_id long, machine_id string, run_date date, shift string, product_id string, planned_production_min long, downtime_min long, total_units long, good_units long, revision int"


def _runs(spark, seed, n=200, ids=400):
    chance = random.Random(seed)
    rows = [
        (k, f"M{chance.randrange(5)}", D + timedelta(chance.randrange(9)), chance.choice("AB"), "P1", 480, chance.randrange(480), t := chance.randrange(1, 90), chance.randrange(t + 1), seed)
        for k in chance.sample(range(ids), n)
    ]
    return spark.createDataFrame(rows, RUNS)


@pytest.fixture(scope="module")
def machines(spark):
    return spark.createDataFrame([(f"M{k}", f"m{k}", "L1" if k < 3 else None, "CNC") for k in range(5)], "machine_id string, machine_name string, line string, machine_type string")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("P1", 30.0)], "product_id string, ideal_cycle_time_sec double")


def test_incremental_gold_equals_the_full_build(spark, tmp_path, rows, machines, products):
    gold = IncrementalGold(spark, str(tmp_path), order=("revision",))
    for batch in range(3):
        gold.take(marts.run_oee(_runs(spark, batch), products), batch)
        facts = gold.facts()
        made = gold.marts(machines, steady)
        assert rows(made["gold_oee_by_machine"], *marts.oee_by_machine(facts, machines).columns) == rows(marts.oee_by_machine(facts, machines, steady))
        assert rows(made["gold_oee_by_line"]) == rows(marts.oee_by_line(facts, machines, steady))
        assert rows(made["gold_shift_performance"]) == rows(marts.shift_performance(facts, steady))
        daily = marts.rolling_oee(marts.daily_oee(facts, steady), rnd=steady)
        assert rows(made["gold_daily_oee"], *daily.columns) == rows(daily)
    assert gold.facts().count() == gold.facts().select("run_id").distinct().count()


def test_only_touched_days_are_read_and_an_emptied_day_goes(spark, tmp_path, products):
    gold = IncrementalGold(spark, str(tmp_path), order=("revision",))
    first = spark.createDataFrame([(k, "M0", D + timedelta(k % 4), "A", "P1", 480, 10, 5, 5, 1) for k in range(12)], RUNS)
    gold.take(marts.run_oee(first, products), 0)
    for file in (tmp_path / "facts" / f"run_date={D + timedelta(3)}").glob("*.parquet"):
        file.write_bytes(b"broken")
    moved = spark.createDataFrame([(k, "M0", D + timedelta(1), "A", "P1", 480, 30, 5, 5, 2) for k in (0, 4, 8)], RUNS)
    assert sorted(gold.take(marts.run_oee(moved, products), 1)) == [D, D + timedelta(1)]
    states = {r.run_date: (r.runs, r.sum_downtime_min) for r in gold.states().read().collect()}
    assert states == {D + timedelta(1): (6, 120), D + timedelta(2): (3, 30), D + timedelta(3): (3, 30)}
    # The same batch again changes nothing.
    gold.take(marts.run_oee(moved, products), 1)
    assert {r.run_date: (r.runs, r.sum_downtime_min) for r in gold.states().read().collect()} == states


def test_states_merge_in_any_split(spark, rows, products):
    oee = marts.run_oee(_runs(spark, 7), products)
    parts = [increments.run_states(oee.filter(F.pmod("run_id", F.lit(3)) == k)) for k in range(3)]
    split = increments.machine_totals(parts[0].unionByName(parts[1]).unionByName(parts[2]), steady)
    assert rows(split) == rows(marts.machine_totals(oee, steady))


SNAP = "machine_id string, machine_name string, line string, maintenance_tier string"


def test_any_order_of_snapshots_gives_the_same_versions(spark, tmp_path, rows):
    """A is confirmed on the third day, so what the second day says holds for one day only, whenever it arrives."""
    days = {D + timedelta(k): [("M1", "one", "A", t), *extra] for k, (t, extra) in enumerate((("x", []), ("y", [("M2", "two", None, None)]), ("x", [("M2", "new", None, None)])))}
    found = []
    for k, order in enumerate(permutations(days)):
        kept = history.ObservedHistory(spark, f"{tmp_path}/{k}", spark.createDataFrame([], SNAP).schema)
        for day in order:
            kept.add(spark.createDataFrame(days[day], SNAP), day)
        found.append(rows(kept.dimension(), "machine_id", "machine_name", "maintenance_tier", "valid_from", "valid_to", "is_current"))
    assert all(f == found[0] for f in found)
    assert found[0] == [
        ("M1", "one", "x", D, D + timedelta(1), False),
        ("M1", "one", "x", D + timedelta(2), None, True),
        ("M1", "one", "y", D + timedelta(1), D + timedelta(2), False),
        ("M2", "two", None, D + timedelta(1), None, True),
    ]


def test_observed_history_equals_snapshots_applied_in_turn(spark, tmp_path, rows):
    chance = random.Random(3)
    snaps = [[(f"M{m}", "n", chance.choice("AB"), chance.choice(("x", None))) for m in chance.sample(range(8), 6)] for _ in range(5)]
    kept = history.ObservedHistory(spark, str(tmp_path), spark.createDataFrame([], SNAP).schema)
    dim = None
    for k, made in enumerate(snaps):
        snap = spark.createDataFrame(made, SNAP)
        dim = history.open_history(snap, D + timedelta(k)) if dim is None else history.apply_snapshot(dim, snap, D + timedelta(k))
    for k in chance.sample(range(5), 5):
        kept.add(spark.createDataFrame(snaps[k], SNAP), D + timedelta(k))
    assert rows(kept.dimension(), *dim.columns) == rows(dim)


def test_observations_are_checked(spark):
    twice = spark.createDataFrame([("M1", "A", "x", D, 1), ("M1", "A", "y", D, 2)], "machine_id string, line string, maintenance_tier string, observed date, load int")
    with pytest.raises(ValueError, match="observations"):
        history.versions_of(twice.drop("load"))
    assert [r.maintenance_tier for r in history.versions_of(twice, order="load").collect()] == ["y"]
    with pytest.raises(ValueError, match="NULL"):
        history.versions_of(twice.withColumn("observed", F.lit(None).cast("date")))
    versions = history.versions_of(twice, order="load")
    assert history.versions_of(history.observations_of(versions)).collect() == versions.collect()
    with pytest.raises(ValueError):
        history.open_history(spark.createDataFrame([("M1",), ("M1",)], "machine_id string"))
    with pytest.raises(ValueError):
        history.open_history(spark.createDataFrame([(None,)], "machine_id string"))


def _plainly(facts, versions):
    out = []
    for k, day, n in facts:
        begun = [(f, t or date.max, a) for key, f, t, a in versions if key == k and k is not None and day is not None and f <= day]
        last = max(begun, default=None)
        out.append((k, day, n, last[2] if last and day < last[1] else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [8, 0])
def test_as_of_join_by_list_and_by_merge(spark, few):
    """Gaps, empty versions, overlaps, unknown and NULL keys and days; one row for each fact either way."""
    chance = random.Random(5)
    versions = [("M1", D, D, "none"), ("M1", D, D + timedelta(4), "a"), ("M1", D + timedelta(6), None, "b"), ("M2", D + timedelta(1), None, "c"), ("M2", D + timedelta(3), D + timedelta(5), "d"), (None, D, None, "e")]
    facts = [(chance.choice(("M1", "M2", "M3", None)), chance.choice([*(D + timedelta(k) for k in range(-1, 9)), None]), n) for n in range(200)]
    frame = spark.createDataFrame(facts, "machine_id string, day date, n int")
    dim = spark.createDataFrame(versions, "machine_id string, valid_from date, valid_to date, tier string")
    got = history.as_of_join(frame, dim, "day", ["tier"], few=few)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plainly(facts, versions)


def test_many_versions_of_one_machine(spark):
    versions = spark.range(10_000).select(F.lit("M1").alias("machine_id"), F.expr("date_add(DATE '1990-01-01', int(id))").alias("valid_from"), F.expr("date_add(DATE '1990-01-01', int(id) + 1)").alias("valid_to"), F.col("id").alias("v"))
    facts = spark.range(50_000).select(F.lit("M1").alias("machine_id"), F.expr("date_add(DATE '1990-01-01', int(id * 7 % 10500))").alias("day"), F.col("id").alias("n"))
    got = history.as_of_join(facts, versions, "day", ["v"])
    wrong = got.filter(~F.col("v").eqNullSafe(F.when(F.col("n") * 7 % 10500 < 10_000, F.col("n") * 7 % 10500)))
    assert got.count() == 50_000 and wrong.count() == 0


def test_a_gated_batch_is_written_once(spark, tmp_path, rows):
    gate = gates.Gate({"positive": "v > 0"})
    schema = spark.createDataFrame([], "k int, v int").schema
    table = GatedTable(spark, f"{tmp_path}/t", schema)
    assert table.read().count() == 0 and table.counts().count() == 0
    landing = f"{tmp_path}/landing"
    for k, made in enumerate(([(1, 1), (2, -1), (3, None)], [(4, 4)])):
        spark.createDataFrame(made, schema).write.mode("append").parquet(landing)
        gate_available(spark.readStream.schema(schema).parquet(landing), table, gate, f"{tmp_path}/c")
        assert table.batches() == list(range(k + 1))
    assert rows(table.counts()) == [(0, 1, 2), (1, 1, 0)]
    # A lost attempt: rows without counts are not seen, and the replay takes their place.
    spark.createDataFrame([(9, 9)], schema).withColumn("is_valid", F.lit(True)).write.partitionBy("is_valid").parquet(f"{tmp_path}/t/rows/batch=2")
    assert table.read().count() == 4
    assert table.write(spark.createDataFrame([(5, -5)], schema), gate, 2) == {"valid": 0, "quarantine": 1}
    assert table.write(spark.createDataFrame([(6, 6)], schema), gate, 2) == {"valid": 0, "quarantine": 1}
    assert rows(table.read(False), "k") == [(2,), (3,), (5,)] and rows(table.read(True), "k") == [(1,), (4,)]
    assert rows(table.read(True, [1]), "k") == [(4,)] and table.batches(after=1) == [2]
