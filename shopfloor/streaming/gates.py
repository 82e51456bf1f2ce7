"""A gate on a stream: every micro-batch writes its two halves and their counts exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from shopfloor.operators.gates import Gate
from shopfloor.sources.files import path_exists

_COUNTS = "batch bigint, valid bigint, quarantine bigint"


class GatedTable:
    """Rows by batch and half (``rows/batch=../is_valid=..``), and one line of counts for each batch.

    The line is written last. A batch without it is not seen by readers, and when it is replayed it
    replaces the folders of the lost attempt; one that has its line is left as it is. ``schema`` is that of
    the rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def counts(self) -> DataFrame:
        """(``batch``, ``valid``, ``quarantine``) of the batches that are whole."""
        if not path_exists(self.spark, f"{self.path}/counts"):
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(f"{self.path}/counts").select("batch", "valid", "quarantine")

    def batches(self, after: int = -1) -> list[int]:
        """Whole batches with an id above ``after``, ascending."""
        return [r["batch"] for r in self.counts().filter(F.col("batch") > after).select("batch").orderBy("batch").collect()]

    def write(self, rows: DataFrame, gate: Gate, batch_id: int) -> dict[str, int]:
        """Write one batch, both halves and their counts in a single pass over ``rows``."""
        known = self.counts().filter(F.col("batch") == batch_id).select("valid", "quarantine").first()
        if known:
            return known.asDict()
        seen = Observation()
        flagged = rows.select(*self.schema.names).withColumn("is_valid", gate.passes()).observe(
            seen, F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("quarantine")
        )
        # The whole folder of the batch is replaced, so nothing of a lost attempt stays.
        flagged.write.mode("overwrite").partitionBy("is_valid").parquet(f"{self.path}/rows/batch={batch_id}")
        found = dict(seen.get)
        line = self.spark.createDataFrame([(found["valid"], found["quarantine"])], "valid bigint, quarantine bigint")
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch_id}")
        return found

    def read(self, valid: bool | None = None, batches: list[int] | None = None) -> DataFrame:
        """The accepted rows, the quarantined ones (both by default, with ``is_valid``), of these batches or of all whole ones."""
        whole = self.batches() if batches is None else [b for b in batches if b in set(self.batches())]
        stored = StructType([*self.schema.fields, StructField("batch", LongType()), StructField("is_valid", BooleanType())])
        if not whole:
            rows = self.spark.createDataFrame([], stored)
        else:
            rows = self.spark.read.schema(stored).parquet(f"{self.path}/rows").filter(F.col("batch").isin(whole))
        rows = rows.drop("batch")
        return rows if valid is None else rows.filter(F.col("is_valid") == valid).drop(*["is_valid"][: int(valid)])


def gate_available(stream: DataFrame, table: GatedTable, gate: Gate, checkpoint: str, clean: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Gate what has arrived since the last call, batch by batch; ``clean`` prepares a batch first."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        table.write(clean(batch) if clean else batch, gate, batch_id)

    stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
