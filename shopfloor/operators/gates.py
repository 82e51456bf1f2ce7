"""Quality gates: a row either passes every rule or is set aside, never lost."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Gate:
    """Named SQL predicates. A rule that evaluates to NULL counts as failed."""

    rules: dict[str, str]

    def passes(self) -> Column:
        return F.coalesce(reduce(and_, [F.expr(rule) for rule in self.rules.values()]), F.lit(False))

    def failed_rules(self) -> Column:
        return F.array_compact(
            F.array(
                *[
                    F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name))
                    for name, rule in self.rules.items()
                ]
            )
        )


RUN_GATE = Gate(
    {
        "machine": "machine_id IS NOT NULL",
        "product": "product_id IS NOT NULL",
        "total_positive": "total_units > 0",
        "good_not_negative": "good_units >= 0",
        "good_within_total": "good_units <= total_units",
    }
)

RUN_GATE_BASIC = Gate({name: RUN_GATE.rules[name] for name in ("product", "total_positive", "good_within_total")})

SENSOR_GATE = Gate(
    {
        "machine": "machine_id IS NOT NULL",
        "speed": "rotational_speed_rpm IS NOT NULL",
        "torque": "torque_nm IS NOT NULL",
    }
)

QUALITY_GATE = Gate(
    {
        "inspection": "inspection_id IS NOT NULL",
        "machine": "machine_id IS NOT NULL",
        "result": "result IN ('PASS', 'FAIL')",
    }
)


def accepted(df: DataFrame, gate: Gate) -> DataFrame:
    # A filter drops NULL by itself, and bare rules reach the scan.
    return df.filter(reduce(and_, [F.expr(rule) for rule in gate.rules.values()]))


def quarantined(df: DataFrame, gate: Gate, reasons: bool = False) -> DataFrame:
    """The rejected rows, with ``is_valid`` kept and, if asked for, the names of the failed rules."""
    out = df.filter(~gate.passes()).withColumn("is_valid", F.lit(False))
    return out.withColumn("_reason", gate.failed_rules()) if reasons else out


def split(df: DataFrame, gate: Gate) -> tuple[DataFrame, DataFrame]:
    return accepted(df, gate), quarantined(df, gate)


def write_split(df: DataFrame, gate: Gate, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write both halves and count them in a single pass over ``df``.

    The flag becomes the partition folder, so each half can be read on its own.
    """
    seen = Observation()
    flagged = df.withColumn("is_valid", gate.passes()).observe(
        seen,
        F.count_if("is_valid").alias("valid"),
        F.count_if(~F.col("is_valid")).alias("quarantine"),
    )
    flagged.write.format(fmt).mode("overwrite").partitionBy("is_valid").save(path)
    return dict(seen.get)


def read_half(spark: SparkSession, path: str, schema: StructType, valid: bool, fmt: str = "parquet") -> DataFrame:
    """One half of a table written by ``write_split``; an absent half is an empty frame.

    ``schema`` is the schema without the flag. Filtering on the partition folder reads only that half.
    """
    flag = "true" if valid else "false"
    with_flag = StructType([*schema.fields, StructField("is_valid", StringType())])
    both = spark.read.format(fmt).schema(with_flag).load(path)
    half = both.filter(F.col("is_valid") == flag)
    return half.drop("is_valid") if valid else half.withColumn("is_valid", F.lit(False))


def audit(named: dict[str, tuple[DataFrame, Gate]]) -> DataFrame:
    """Rows per table and status; every source is scanned once."""
    parts = []
    for name, (df, gate) in named.items():
        counts = df.agg(
            F.count_if(gate.passes()).alias("valid"), F.count_if(~gate.passes()).alias("quarantine")
        )
        parts.append(
            counts.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(name).alias("table_name"),
                                F.lit(status).alias("status"),
                                F.col(status).alias("row_count"),
                            )
                            for status in ("valid", "quarantine")
                        ]
                    )
                )
            )
        )
    return reduce(DataFrame.unionByName, parts)
