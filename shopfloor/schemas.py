"""Column contracts of the raw tables, and a projection that makes a frame fit one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: str) -> T.StructType:
    """``name type, ...`` as a schema; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


READINGS = _struct(
    "temperature_c double, vibration_mm_s double, rotational_speed_rpm bigint, torque_nm double, tool_wear_min bigint"
)

MACHINES = _struct(
    "machine_id string, machine_name string, line string, machine_type string, maintenance_tier string, install_date string"
)
PRODUCTS = _struct("product_id string, product_name string, ideal_cycle_time_sec double")
RUNS = _struct(
    "run_id string, run_date string, machine_id string, product_id string, shift string, planned_production_min bigint,"
    " downtime_min bigint, total_units bigint, good_units bigint, ingested_at string"
)
SENSORS = (
    _struct("machine_id string, reading_ts string, firmware string, source string")
    .add("readings", READINGS)
    .add("machine_failure", T.BooleanType())
)
QUALITY = _struct(
    "inspection_id string, machine_id string, product_id string, inspected_ts string, result string,"
    " defect_code string, inspector string"
)
DOWNTIME_EVENTS = _struct(
    "event_id bigint, event_date date, machine_id string, line string, shift string, reason string,"
    " loss_category string, planned_type string, duration_min bigint"
)

# Fixed column names of the 14-column seed file, in file order.
SEED_COLUMNS = [
    "udi", "product_id", "type", "air_temp_k", "process_temp_k", "rot_speed", "torque", "tool_wear",
    "machine_failure", "twf", "hdf", "pwf", "osf", "rnf",
]


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: cast what exists, add what is missing as a typed NULL."""
    return df.select(*[_fitted(df.schema, None, field).alias(field.name) for field in contract])


def _fitted(have: T.StructType, parent, field: T.StructField):
    if field.name not in have.names:
        return F.lit(None).cast(field.dataType)
    source = F.col(field.name) if parent is None else parent.getField(field.name)
    inner = have[field.name].dataType
    if isinstance(field.dataType, T.StructType) and isinstance(inner, T.StructType):
        fitted = F.struct(*[_fitted(inner, source, sub).alias(sub.name) for sub in field.dataType])
        return F.when(source.isNotNull(), fitted)
    return source if inner == field.dataType else source.cast(field.dataType)
