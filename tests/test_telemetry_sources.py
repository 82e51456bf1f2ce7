from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor import schemas
from shopfloor.functions.cleaning import padded_id
from shopfloor.operators import telemetry
from shopfloor.session import shared_dir, stage, work_folder
from shopfloor.sources import catalog, files
from shopfloor.sources.versioned import VersionedTable


def _landed(tmp_path, name, records, multiline=False):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, indent=1) if multiline else "".join(json.dumps(r) + "\n" for r in records))
    return str(path)


SHORT = {"machine_id": "M01", "reading_ts": "2024-01-01T10:00:00+00:00", "readings": {"temperature_c": 60.1, "torque_nm": 40.0}}
FULL = {"machine_id": "M02", "reading_ts": "x", "readings": {"temperature_c": 61.0, "torque_nm": 41.0, "rotational_speed_rpm": 1500, "tool_wear_min": 7}}


def test_flatten_accepts_both_reading_shapes(spark, tmp_path):
    short = telemetry.clean_readings(files.read_json(spark, _landed(tmp_path, "a.json", [SHORT]), lineage=False))
    row = short.first()
    assert row["tool_wear_min"] is None and row["temperature_c"] == 60.1 and row["reading_ts"] is not None
    full = telemetry.clean_readings(files.read_json(spark, _landed(tmp_path, "b.json", [FULL]), lineage=False))
    assert full.first()["tool_wear_min"] == 7 and full.first()["reading_ts"] is None
    assert set(short.columns) == set(full.columns)
    assert "readings" not in full.columns


def test_contract_and_inference_agree(spark, tmp_path):
    path = _landed(tmp_path, "c.json", [SHORT, FULL])
    typed = files.read_json(spark, path, schemas.SENSORS, lineage=False)
    inferred = schemas.conform(files.read_json(spark, path, lineage=False), schemas.SENSORS)
    assert typed.schema == inferred.schema or [f.dataType for f in typed.schema] == [f.dataType for f in inferred.schema]
    assert sorted(map(str, typed.collect())) == sorted(map(str, inferred.collect()))


def test_conform_adds_casts_and_drops(spark):
    df = spark.createDataFrame([(1, "x")], "machine_id int, extra string")
    got = schemas.conform(df, schemas.MACHINES)
    assert got.columns == schemas.MACHINES.names
    assert got.first()["machine_id"] == "1" and got.first()["line"] is None
    empty = spark.createDataFrame([(None,)], T.StructType([T.StructField("readings", schemas.READINGS)]))
    assert schemas.conform(empty, T.StructType([T.StructField("readings", schemas.READINGS)])).first()["readings"] is None


def test_multiline_and_name_filter(spark, tmp_path):
    _landed(tmp_path, "mes/runs_1.json", [{"run_id": "a"}, {"run_id": "b"}])
    _landed(tmp_path, "mes/runs_2.json", [{"run_id": "c"}])
    _landed(tmp_path, "mes/machines.json", [{"run_id": "no"}])
    runs = files.read_json(spark, f"{tmp_path}/mes", schemas.RUNS, glob_filter="runs_*.json")
    assert sorted(r["run_id"] for r in runs.collect()) == ["a", "b", "c"]
    assert runs.select("_source_file").distinct().count() == 2
    assert all(r["_ingest_time"] is not None for r in runs.collect())
    many = _landed(tmp_path, "multi.json", [{"run_id": "a"}, {"run_id": "b"}], multiline=True)
    assert files.read_json(spark, many, multiline=True, lineage=False).count() == 2


def test_broken_json_reaches_the_gate_as_nulls(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"machine_id": "M01"\n{"machine_id": "M02"}\n')
    assert sorted(str(r["machine_id"]) for r in files.read_json(spark, str(path), schemas.RUNS).collect()) == ["M02", "None"]


HEADER = "UDI, Product ID ,Type,Air temperature [K],Process temperature [K],Rotational speed [rpm],Torque [Nm],TOOL WEAR [min],Machine failure,TWF,HDF,PWF,OSF,RNF"


@pytest.fixture
def seed_csv(tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(HEADER + "\n1,M1,L,298.1,308.64,1551,42.84,0,0,0,0,0,0,0\n2,M2,M,298.2,,1408.0,46.3,3,1,0,0,0,0,0\n")
    return str(path)


def test_seed_scan_names_by_position(spark, seed_csv):
    df = files.read_seed_csv(spark, seed_csv)
    assert df.columns == schemas.SEED_COLUMNS
    assert dict(df.dtypes)["air_temp_k"] == "double" and dict(df.dtypes)["udi"] == "int"


def test_seed_maps_to_telemetry(spark, seed_csv):
    seed = files.read_seed_csv(spark, seed_csv, names=None)
    got = telemetry.seed_to_telemetry(seed, F.lit("M01"), F.lit("2024-01-01T00:00:00")).orderBy("readings.tool_wear_min").collect()
    one, two = got[0]["readings"], got[1]["readings"]
    assert (one["temperature_c"], one["rotational_speed_rpm"], one["torque_nm"], one["tool_wear_min"]) == (35.5, 1551, 42.8, 0)
    assert two["temperature_c"] is None and two["rotational_speed_rpm"] == 1408
    assert [r["machine_failure"] for r in got] == [False, True]
    assert all(r["readings"]["vibration_mm_s"] is None for r in got)


def test_padded_id(spark):
    df = spark.createDataFrame([(7,), (42,), (123,)], "n int")
    assert [r[0] for r in df.select(padded_id("M", F.col("n"), 2)).collect()] == ["M07", "M42", "M123"]


def test_write_counts_in_the_same_pass(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, day int")
    assert files.write_table(df, f"{tmp_path}/t") == 30
    assert files.write_table(df.filter("id < 10"), f"{tmp_path}/t", partition_by="day") == 10
    assert files.read_table(spark, f"{tmp_path}/t").count() == 10


def test_path_exists(spark, tmp_path):
    assert not files.path_exists(spark, f"{tmp_path}/no")
    spark.range(1).write.parquet(f"{tmp_path}/yes")
    assert files.path_exists(spark, f"{tmp_path}/yes")


def test_versioned_table_rewrites_itself_and_travels_back(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/dim")
    assert not table.exists()
    assert table.overwrite(spark.range(3).toDF("id")) == 0
    assert table.overwrite(table.read().withColumn("id", F.col("id") + 10)) == 1
    assert sorted(r["id"] for r in table.read().collect()) == [10, 11, 12]
    assert sorted(r["id"] for r in table.read(0).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        table.read(7)


def test_catalog_tables(spark, tmp_path):
    catalog.use(spark, "plant_test")
    try:
        df = spark.createDataFrame([(1, "a")], "id int, v string")
        assert not catalog.exists(spark, "t1")
        catalog.create(df, "t1", f"{tmp_path}/t1")
        with pytest.raises(AnalysisException):
            catalog.create(df, "t1", f"{tmp_path}/t1")
        catalog.append(df, "t1")
        assert spark.table("t1").count() == 2
        catalog.overwrite(df, "t1", f"{tmp_path}/t1b")
        assert spark.table("t1").count() == 1
        catalog.drop(spark, "t1", "never_there")
        assert not catalog.exists(spark, "t1")
    finally:
        catalog.use(spark, "default")
        spark.sql("DROP SCHEMA plant_test CASCADE")


def test_stage_uses_the_folder_the_session_names(spark):
    staged = stage(spark.range(5).toDF("id"))
    assert staged.inputFiles()[0].startswith("file://" + shared_dir(spark))
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert work_folder(spark, "a") != work_folder(spark, "a")


def test_without_a_shared_folder_only_a_local_session_gets_its_own(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId = "app-1"
        master = "local[2]"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    local = shared_dir(Session())
    assert local == shared_dir(Session())
    Context.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
