"""Undeclared fields that become columns, versions that are retained, and what staging scopes leave behind."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shopfloor.session import drop_staged, shared_dir, stage, staged_of, staging
from shopfloor.sources.drift import FieldLedger, widened
from shopfloor.sources.files import UNDECLARED
from shopfloor.sources.versioned import VersionedTable


def _raw(spark, *maps):
    return spark.createDataFrame(list(enumerate(maps)), f"id int, {UNDECLARED} map<string,string>")


def test_types_are_learnt_and_widened(spark, tmp_path):
    ledger = FieldLedger(spark, f"{tmp_path}/fields")
    assert ledger.types() == {} and ledger.learn(_raw(spark, {}, None)) == {}
    first = _raw(spark, {"a": "1", "b": "1.5", "c": "true", "d": "007"}, {"a": "-20", "b": "2", "c": "false", "e": None})
    assert ledger.learn(first) == {"a": "bigint", "b": "double", "c": "boolean", "d": "string"}
    assert ledger.learn(_raw(spark, {"a": "1e3", "c": "3"})) == {"a": "double", "b": "double", "c": "string", "d": "string"}
    assert ledger.learn(_raw(spark, {"a": "12345678901234567890123"}))["a"] == "double"
    assert widened("bigint", "boolean") == "string" and widened(None, "bigint") == "bigint"


def test_promoted_fields_lose_nothing(spark, tmp_path):
    ledger = FieldLedger(spark, f"{tmp_path}/fields")
    ledger.learn(_raw(spark, {"speed": "3", "readings.x": "true", "id": "9"}))
    got = ledger.promoted(_raw(spark, {"speed": "4", "id": "7"}, {"speed": "fast", "new": "n"}, {"readings.x": "false"}, None)).orderBy("id")
    assert dict(got.dtypes)["speed"] == "bigint" and dict(got.dtypes)["readings_x"] == "boolean"
    rows = [(r.speed, r.readings_x, r[UNDECLARED]) for r in got.collect()]
    # A value of another type stays as text, a name that is taken stays in the map.
    assert rows == [(4, None, {"id": "7"}), (None, None, {"speed": "fast", "new": "n"}), (None, False, {}), (None, None, None)]


def test_versions_are_retained(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    for k in range(4):
        table.overwrite(spark.range(k + 1))
    assert table.retain(2) == [0, 1] and table.retain(2) == []
    assert table.read().count() == 4 and table.read(2).count() == 3 and len(os.listdir(f"{tmp_path}/t/data")) == 2
    with pytest.raises(ValueError):
        table.read(1)
    assert table.overwrite(table.read().limit(1)) == 4 and table.read().count() == 1
    with pytest.raises(ValueError):
        table.retain(0)


def test_a_scope_leaves_only_its_result(spark):
    drop_staged(spark)
    before = set(os.listdir(shared_dir(spark)))
    with staging(spark) as scope:
        part = stage(spark.range(10), "part")
        assert staged_of(part) and not staged_of(spark.range(3))
        kept = scope.result(part.filter("id > 4"))
    assert kept.count() == 5 and len(set(os.listdir(shared_dir(spark))) - before) == 1
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(spark.range(3), "lost")
        raise ZeroDivisionError
    assert len(set(os.listdir(shared_dir(spark))) - before) == 1 and drop_staged(spark) == 1
