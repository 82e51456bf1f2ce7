"""The given star-schema tables seen as plant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopfloor.functions.cleaning import parsed_timestamp, standard_code
from shopfloor.operators.gates import QUALITY_GATE, RUN_GATE, SENSOR_GATE, accepted
from shopfloor.operators.joins import lookup_join
from shopfloor.operators.losses import categorise
from shopfloor.operators.marts import run_oee
from shopfloor.operators.telemetry import clean_readings


# Schemas of the tables opened so far, by path and the time it was last written; reading them takes a job each.
_SCHEMAS: dict[tuple[str, int], StructType] = {}


class Plant:
    """Plant tables bound to one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        status = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place)
        known = (path, status.getModificationTime())
        if known not in _SCHEMAS:
            _SCHEMAS[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[known]).parquet(path)

    def machines(self) -> DataFrame:
        placed = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return placed.select(
            F.col("s_suppkey").alias("machine_id"),
            F.col("s_name").alias("machine_name"),
            F.col("r_name").alias("line"),
            F.col("n_name").alias("machine_type"),
            (F.col("s_suppkey") % 18 + 1).alias("age_years"),
            F.when(F.col("s_acctbal") > 5000, "premium").otherwise("standard").alias("maintenance_tier"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            (F.col("p_size") + 10).cast("double").alias("ideal_cycle_time_sec"),
        )

    def runs(self) -> DataFrame:
        return self._runs_of(self.table("lineitem"))

    def _runs_of(self, items: DataFrame, *more: str) -> DataFrame:
        made = F.floor(F.col("l_extendedprice") / 100)
        return items.select(
            *more,
            F.col("l_shipdate").cast("date").alias("run_date"),
            F.col("l_suppkey").alias("machine_id"),
            F.when(F.col("l_orderkey") % 25 != 0, F.col("l_partkey")).alias("product_id"),
            F.when(F.col("l_linenumber") % 3 == 0, "morning")
            .when(F.col("l_linenumber") % 3 == 1, "afternoon")
            .otherwise("night")
            .alias("shift"),
            F.lit(480).cast("bigint").alias("planned_production_min"),
            (F.col("l_quantity").cast("bigint") * 5).alias("downtime_min"),
            F.when(F.col("l_orderkey") % 33 == 0, -1)
            .when(F.col("l_orderkey") % 101 == 0, None)
            .otherwise(made)
            .cast("bigint")
            .alias("total_units"),
            (made - F.floor(made * F.col("l_discount"))).cast("bigint").alias("good_units"),
        )

    def keyed_runs(self) -> DataFrame:
        """The gated runs with ``run_id``, ``number`` (of the order they belong to) and their month."""
        keyed = self.table("lineitem").select(
            F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"), F.round(F.col("l_extendedprice") * 100).cast("bigint")
            ).alias("run_id"),
            F.col("l_orderkey").alias("number"),
            "*",
        )
        return self._runs_of(keyed, "run_id", "number")

    def silver_runs(self) -> DataFrame:
        return accepted(self.runs(), RUN_GATE)

    def run_oee(self) -> DataFrame:
        return run_oee(self.silver_runs(), self.products())

    def downtime_events(self) -> DataFrame:
        reason = (
            F.when(F.col("event_type") == "error", "Breakdown")
            .when(F.col("event_type") == "signup", "Changeover")
            .when(F.col("event_type") == "purchase", "Planned Maintenance")
            .when(F.col("event_type") == "click", "Minor Stop")
            .when(F.col("event_type") == "view", "Reduced Speed")
        )
        events = self.table("events").select(
            "event_id",
            F.col("ts").cast("date").alias("event_date"),
            F.col("user_id").alias("machine_id"),
            reason.alias("reason"),
            F.floor("value").cast("bigint").alias("duration_min"),
        )
        return categorise(events)

    def raw_sensors(self) -> DataFrame:
        speed = F.get_json_object("props", "$.k").cast("bigint")
        return self.table("events").select(
            F.col("event_id").alias("reading_id"),
            F.col("user_id").alias("machine_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("reading_ts"),
            F.struct(
                (F.lit(20.0) + F.col("value") / 10).alias("temperature_c"),
                F.when(F.col("event_id") % 33 != 0, speed).alias("rotational_speed_rpm"),
                F.col("value").alias("torque_nm"),
                (F.col("event_id") % 250).alias("tool_wear_min"),
            ).alias("readings"),
            (F.col("event_type") == "error").alias("machine_failure"),
        )

    def silver_sensors(self) -> DataFrame:
        return accepted(clean_readings(self.raw_sensors()), SENSOR_GATE)

    def raw_quality(self) -> DataFrame:
        machines = self.table("supplier").select(F.count("*")).scalar()
        result = (
            F.when(F.col("o_orderkey") % 50 == 0, None)
            .when(F.col("o_orderstatus") == "F", " fail ")
            .when(F.col("o_orderstatus") == "O", "pass")
            .when(F.col("o_orderstatus") == "P", "Unknown")
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("inspection_id"),
            (F.col("o_custkey") % machines).alias("machine_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("inspected_ts"),
            result.alias("result"),
            F.when(result.isNull() | (result != "pass"), F.col("o_orderpriority")).alias("defect_code"),
        )

    def clean_quality(self) -> DataFrame:
        return self.raw_quality().withColumns(
            {
                "inspected_ts": parsed_timestamp(F.col("inspected_ts")),
                "result": standard_code(F.col("result")),
            }
        )

    def silver_quality(self) -> DataFrame:
        return accepted(self.clean_quality(), QUALITY_GATE)

    def snapshot(self, when: int) -> DataFrame:
        """The machine dimension at the first (0) or second (1) load."""
        cols = ["machine_id", "machine_name", "line", "machine_type", "maintenance_tier"]
        machines = self.machines().select(*cols)
        if when == 0:
            return machines.filter("machine_id % 10 <> 9")
        return machines.withColumns(
            {
                "line": F.expr("CASE WHEN machine_id % 11 = 0 THEN concat(line, '-X') ELSE line END"),
                "maintenance_tier": F.expr(
                    "CASE WHEN machine_id % 13 = 0 THEN NULL"
                    " WHEN machine_id % 7 = 0 AND maintenance_tier = 'premium' THEN 'standard'"
                    " WHEN machine_id % 7 = 0 THEN 'premium' ELSE maintenance_tier END"
                ),
            }
        )

    def learning_frame(self) -> DataFrame:
        """Line items with part features; the label is a returned item."""
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
        joined = lookup_join(self.table("lineitem"), parts, ["l_partkey"], "inner")
        return joined.select(
            *LEARNING_KEYS,
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("p_size").cast("double").alias("size"),
            F.col("p_retailprice").alias("retailprice"),
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
        )


LEARNING_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LEARNING_FEATURES = ["quantity", "discount", "tax", "size", "retailprice"]
