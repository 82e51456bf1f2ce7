"""A Parquet table that is replaced as a whole and keeps its earlier versions.

Each write goes to a folder of its own and is then entered in a small list of versions, so a table
can be rebuilt from itself, a failed write is never seen, and earlier versions stay readable. One
writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.sources.files import delete_path, path_exists

_ENTRY = "version bigint, folder string, written_at timestamp"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    def history(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/versions")

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/versions")

    def _entry(self, version: int | None):
        entries = self.history()
        if version is not None:
            entries = entries.filter(F.col("version") == version)
        return entries.orderBy(F.desc("version")).limit(1).collect()

    def read(self, version: int | None = None) -> DataFrame:
        """The latest version, or an earlier one by number."""
        entry = self._entry(version)
        if not entry:
            raise ValueError(f"{self.path} has no version {version}")
        return self.spark.read.format(self.fmt).load(f"{self.path}/{entry[0]['folder']}")

    def overwrite(self, df: DataFrame) -> int:
        """Write ``df`` (which may read this very table) as the next version; returns its number."""
        last = self._entry(None) if self.exists() else []
        version = last[0]["version"] + 1 if last else 0
        folder = f"data/v{version}-{uuid.uuid4().hex[:8]}"
        df.write.format(self.fmt).save(f"{self.path}/{folder}")
        (
            self.spark.range(1)
            .select(
                F.lit(version).cast("bigint").alias("version"),
                F.lit(folder).alias("folder"),
                F.current_timestamp().alias("written_at"),
            )
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/versions")
        )
        return version

    def retain(self, versions: int) -> list[int]:
        """Forget and delete all but the last ``versions`` versions; returns the numbers of those that went.

        The list is written first, so a version that is listed can always be read. Whoever reads a version
        that goes must be done with it.
        """
        if versions < 1:
            raise ValueError("the last version can't go")
        entries = self.history().orderBy(F.desc("version")).collect()
        kept, gone = entries[:versions], entries[versions:]
        if gone:
            self.spark.createDataFrame(kept, _ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions")
            for entry in gone:
                delete_path(self.spark, f"{self.path}/{entry['folder']}")
        return sorted(entry["version"] for entry in gone)
