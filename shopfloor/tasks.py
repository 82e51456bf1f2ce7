"""Python functions in tasks: makes this package known to the workers of any cluster."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import shopfloor

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.abspath(shopfloor.__file__))
    path = os.path.join(tempfile.mkdtemp(), "shopfloor_modules.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def release() -> None:
    """Give memory that is free again back to the system: workers live on after a task, and idle ones hold what they keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others have none
    if trim:
        trim(0)


def mapped(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers, which give memory back after each task."""
    ship(df.sparkSession)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)
