"""Micro-batch upserts into a partitioned fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopfloor.operators.merge import latest_per_key, upsert_partitions


def upsert_available(
    stream: DataFrame,
    table_path: str,
    keys: list[str],
    partition_by: str,
    checkpoint: str,
    order: list[str],
) -> None:
    """Upsert what has landed, batch by batch; the newest row of a key (by ``order``) wins, whichever batch it came with.

    A batch that Spark replays is recognised by its id.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, order)
        upsert_partitions(table_path, newest, keys, partition_by, batch_id, log=f"{checkpoint}-upserts", order=order, unique=True)

    query = (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
