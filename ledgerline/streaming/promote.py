"""Incremental promotion of raw files: a file-source stream whose checkpoint is the ledger, upserting each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import store


def promote(spark: SparkSession, raw: str, schema: str, table: str, checkpoint: str, keys: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df, by: str | None = None, files: int = 200, partition: str | None = None, first: bool = False) -> None:
    """Takes all files under raw that no earlier call took, at most `files` a batch, through prepare into the table. A batch that is repeated after a failure merges to the same rows.

    partition: only the partitions that a batch touches are written anew. first: a key's first capture stays, whatever comes later.
    """

    def each(batch: DataFrame, _: int) -> None:
        store.upsert(prepare(batch), table, keys, partition, by, first)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(raw)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
