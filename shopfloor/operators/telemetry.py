"""Sensor telemetry: flattening and seed-file mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.functions.cleaning import parsed_timestamp
from shopfloor.functions.kpi import kelvin_to_celsius
from shopfloor.functions.rounding import Rounder, half_up
from shopfloor.schemas import READINGS


# Fixed value: how telemetry made from the seed file names its source.
SEED_SOURCE = "ai4i-seed"


def flatten_readings(df: DataFrame, struct: str = "readings") -> DataFrame:
    """Lift every field of the struct to a column; readings the source never had become typed NULLs."""
    present = df.schema[struct].dataType.names
    missing = [f for f in READINGS if f.name not in present and f.name not in df.columns]
    return df.select(
        *[c for c in df.columns if c != struct],
        *[F.col(struct).getField(name).alias(name) for name in present],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing],
    )


def clean_readings(df: DataFrame) -> DataFrame:
    """Flat telemetry with a real timestamp, ready for the sensor gate."""
    return flatten_readings(df).withColumn("reading_ts", parsed_timestamp(F.col("reading_ts")))


def _by_header(df: DataFrame, *names: str) -> Column:
    """The first column whose header matches one of ``names``, ignoring case and outer blanks."""
    headers = {c.strip().lower(): c for c in df.columns}
    for name in names:
        if name.strip().lower() in headers:
            text = F.trim(df[f"`{headers[name.strip().lower()]}`"].cast("string"))
            return F.when(text != "", text)
    return F.lit(None).cast("string")


def seed_to_telemetry(
    seed: DataFrame,
    machine_id: Column,
    reading_ts: Column,
    firmware: Column | None = None,
    vibration: Column | None = None,
    rnd: Rounder = half_up,
) -> DataFrame:
    """Map the predictive-maintenance seed file onto nested telemetry records.

    The file has no machine, time, firmware or vibration; the caller says where they come from.
    Vibration stays NULL unless it is given.
    """
    process_k = _by_header(seed, "Process temperature [K]", "Process temperature").cast("double")
    speed = _by_header(seed, "Rotational speed [rpm]", "Rotational speed").cast("double")
    torque = _by_header(seed, "Torque [Nm]", "Torque").cast("double")
    wear = _by_header(seed, "Tool wear [min]", "Tool wear").cast("double")
    failed = _by_header(seed, "Machine failure", "Target").cast("double")
    vibration = F.lit(None) if vibration is None else vibration
    return seed.select(
        machine_id.alias("machine_id"),
        reading_ts.alias("reading_ts"),
        (F.lit("v1.2") if firmware is None else firmware).alias("firmware"),
        F.lit(SEED_SOURCE).alias("source"),
        F.struct(
            rnd(kelvin_to_celsius(process_k), 1).alias("temperature_c"),
            vibration.cast("double").alias("vibration_mm_s"),
            speed.cast("bigint").alias("rotational_speed_rpm"),
            rnd(torque, 1).alias("torque_nm"),
            wear.cast("bigint").alias("tool_wear_min"),
        ).alias("readings"),
        (F.coalesce(failed, F.lit(0.0)) != 0).alias("machine_failure"),
    )
