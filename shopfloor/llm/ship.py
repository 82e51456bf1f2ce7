"""Python functions in tasks over documents: small Arrow batches, and columns under names of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor import tasks

_sized: set[str] = set()
#: Rows of an Arrow batch: whole documents are far longer than the rows Spark's default is made for.
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once for each application; Arrow batches become small unless their size is set."""
    app = spark.sparkContext.applicationId
    if app not in _sized and spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)
    _sized.add(app)
    tasks.ship(spark)


def beside(docs: DataFrame, kept: list[str], **more: Column) -> DataFrame:
    """The columns ``kept`` as ``c0``, ``c1``, ..., and ``more``: names made for a task can't clash with those of the caller."""
    return docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], *[column.alias(name) for name, column in more.items()])


def named(df: DataFrame, kept: list[str], *more: str) -> DataFrame:
    """The columns ``c0``, ``c1``, ... under the names ``kept`` again, and ``more``."""
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *more)


def renamed(fields: list[T.StructField], names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, fields)]


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``tasks.mapped`` in small Arrow batches."""
    ship(df.sparkSession)
    return tasks.mapped(df, function, schema)
