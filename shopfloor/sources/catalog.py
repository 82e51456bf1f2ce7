"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Make a schema (created if absent) the current one."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.catalog.setCurrentDatabase(schema)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def overwrite(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Replace a table, managed unless ``path`` is given."""
    writer = df.write.format(fmt).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def create(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Create a table; fails if it is there."""
    writer = df.write.format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, name: str) -> None:
    """INSERT INTO: columns are matched by position."""
    df.write.insertInto(name)
