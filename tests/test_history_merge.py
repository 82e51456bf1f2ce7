from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import history, merge

DIM = "machine_id string, machine_name string, line string, machine_type string, maintenance_tier string, install_date string"
D0, D1, D2 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


def snap(spark, *made):
    return spark.createDataFrame([(m, n, l, "CNC", t, "2019-03-12") for m, n, l, t in made], DIM)


@pytest.fixture
def first(spark):
    return snap(spark, ("M1", "one", "A", "standard"), ("M2", "two", "A", None), ("M3", "three", "B", "premium"), ("M4", "four", "B", "premium"))


@pytest.fixture
def second(spark):
    # tier change, NULL tier filled, untracked name change, M4 missing, M5 new
    return snap(spark, ("M1", "one", "A", "premium"), ("M2", "two", "A", "standard"), ("M3", "THREE", "B", "premium"), ("M5", "five", "C", None))


def test_classify(spark, first, second, rows):
    got = history.classify(history.open_history(first, D0), second)
    assert rows(got, "machine_id", "change") == [("M1", "changed"), ("M2", "changed"), ("M3", "unchanged"), ("M5", "new")]
    assert {"cur_line", "cur_maintenance_tier"} <= set(got.columns)


def test_apply(spark, first, second, rows):
    got = history.apply_snapshot(history.open_history(first, D0), second, D1)
    assert rows(got, "machine_id", "machine_name", "maintenance_tier", "valid_from", "valid_to", "is_current") == sorted(
        [
            ("M1", "one", "standard", D0, D1, False),
            ("M1", "one", "premium", D1, None, True),
            ("M2", "two", None, D0, D1, False),
            ("M2", "two", "standard", D1, None, True),
            ("M3", "three", "premium", D0, None, True),
            ("M4", "four", "premium", D0, None, True),
            ("M5", "five", None, D1, None, True),
        ],
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def test_apply_equals_its_parts(spark, first, second, rows):
    existing = history.apply_snapshot(history.open_history(first, D0), second, D1)
    third = second.withColumn("line", F.when(F.col("machine_id") == "M1", "Z").otherwise(F.col("line")))
    changes = history.classify(existing, third)
    fresh = history.open_history(changes.filter("change <> 'unchanged'").select(*third.columns), D2)
    parts = (
        existing.filter("NOT is_current")
        .unionByName(history.to_keep(existing, changes))
        .unionByName(history.to_expire(existing, changes, D2))
        .unionByName(fresh)
    )
    assert rows(history.apply_snapshot(existing, third, D2)) == rows(parts)


def test_same_snapshot_again_changes_nothing(spark, first, second, rows):
    once = history.apply_snapshot(history.open_history(first, D0), second, D1)
    assert rows(history.apply_snapshot(once, second, D1)) == rows(once)
    assert rows(history.apply_snapshot(once, second, D2)) == rows(once)


def test_history_invariants(spark, first, second):
    dim = history.apply_snapshot(history.open_history(first, D0), second, D1)
    dim = history.apply_snapshot(dim, first, D2)
    assert dim.filter("is_current").groupBy("machine_id").count().filter("count <> 1").count() == 0
    a, b = dim.alias("a"), dim.alias("b")
    overlap = a.join(
        b,
        (F.col("a.machine_id") == F.col("b.machine_id"))
        & (F.col("a.valid_from") < F.col("b.valid_from"))
        & (F.coalesce("a.valid_to", F.lit(date(9999, 1, 1))) > F.col("b.valid_from")),
    )
    assert overlap.count() == 0
    for day, n in ((D0, 4), (date(2024, 2, 15), 5), (D2, 5)):
        assert history.as_of(dim, day).count() == n


def test_duplicate_snapshot_keys_are_refused(spark, first):
    with pytest.raises(ValueError, match="snapshot"):
        history.apply_snapshot(history.open_history(first, D0), first.unionAll(first), D1)


def test_as_of_join(spark, first, second, rows):
    dim = history.apply_snapshot(history.open_history(first, D0), second, D1)
    facts = spark.createDataFrame(
        [(1, "M1", date(2024, 1, 31)), (2, "M1", D1), (3, "M9", D1), (4, "M5", D0), (5, None, D0)], "id int, machine_id string, day date"
    )
    got = history.as_of_join(facts, dim, "day", ["maintenance_tier"])
    assert rows(got, "id", "maintenance_tier") == [(1, "standard"), (2, "premium"), (3, None), (4, None), (5, None)]


def test_default_day_is_today(spark, first):
    today = spark.sql("SELECT current_date()").first()[0]
    assert history.open_history(first).first()["valid_from"] == today


T = "k int, a string, n int"


def test_merge_update_insert_and_condition(spark, rows):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", 3)], T)
    source = spark.createDataFrame([(2, "Y", 20), (3, "Z", 30), (4, "W", 40)], T)
    both = merge.merge_df(target, source, ["k"], {"a": F.col("s.a")}, when=F.col("s.n") > 20, insert=True)
    assert rows(both) == [(1, "x", 1), (2, "y", 2), (3, "Z", 3), (4, "W", 40)]
    only = merge.merge_df(target, source, ["k"], {"n": F.col("t.n") + F.col("s.n")})
    assert rows(only) == [(1, "x", 1), (2, "y", 22), (3, "z", 33)]
    some = merge.merge_df(target, source, ["k"], insert={"k": F.col("s.k"), "a": F.lit("new")})
    assert rows(some)[-1] == (4, "new", None)


def test_merge_with_extra_match_condition(spark, rows):
    target = spark.createDataFrame([(1, "old", 0), (1, "live", 1)], T)
    source = spark.createDataFrame([(1, "s", 9)], T)
    got = merge.merge_df(target, source, ["k"], {"a": F.lit("hit")}, on=F.col("t.n") == 1)
    assert rows(got) == [(1, "hit", 1), (1, "old", 0)]


def test_upsert_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], T)
    source = spark.createDataFrame([(2, "Y", 20), (4, "W", 40)], T)
    once = merge.upsert_df(target, source, ["k"])
    assert rows(once) == [(1, "x", 1), (2, "Y", 20), (4, "W", 40)]
    assert rows(merge.upsert_df(once, source, ["k"])) == rows(once)


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 3), (1, "z", 2), (2, "w", 1)], T)
    assert rows(merge.latest_per_key(df, ["k"], ["n"])) == [(1, "y", 3), (2, "w", 1)]


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path, rows):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    first = spark.createDataFrame([(1, "x", 2020), (2, "y", 2021), (3, "z", 2021)], T)
    merge.upsert_partitions(path, first, ["k"], "n", 0, log)
    untouched = sorted((tmp_path / "t" / "n=2020").glob("*.parquet"))
    change = spark.createDataFrame([(2, "Y", 2021), (4, "w", 2022)], T)
    merge.upsert_partitions(path, change, ["k"], "n", 1, log)
    read = lambda: rows(spark.read.schema(first.schema).parquet(path))
    assert read() == [(1, "x", 2020), (2, "Y", 2021), (3, "z", 2021), (4, "w", 2022)]
    assert sorted((tmp_path / "t" / "n=2020").glob("*.parquet")) == untouched
    # A replayed batch does nothing, whatever it carries.
    merge.upsert_partitions(path, first, ["k"], "n", 1, log)
    assert read()[1] == (2, "Y", 2021)


def test_upsert_resumes_after_staging(spark, tmp_path, rows):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    first = spark.createDataFrame([(1, "x", 2020), (2, "y", 2021)], T)
    merge.upsert_partitions(path, first, ["k"], "n", 0, log)
    # The batch was staged and logged, then the job died before the swap.
    staged = spark.createDataFrame([(2, "Y", 2021)], T)
    staged.write.mode("overwrite").parquet(f"{log}/merged")
    spark.createDataFrame([], "folder string").write.mode("overwrite").parquet(f"{log}/emptied")
    merge._record(spark, log, 1, "staged")
    merge.upsert_partitions(path, staged, ["k"], "n", 1, log)
    assert rows(spark.read.schema(first.schema).parquet(path)) == [(1, "x", 2020), (2, "Y", 2021)]


def test_upsert_refuses_duplicate_keys(spark, tmp_path):
    twice = spark.createDataFrame([(1, "x", 2020), (1, "y", 2020)], T)
    with pytest.raises(ValueError, match="upsert batch"):
        merge.upsert_partitions(f"{tmp_path}/t", twice, ["k"], "n", 0, f"{tmp_path}/log")
