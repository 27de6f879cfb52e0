"""What was captured first stays, over an unbounded horizon, without a look at what is stored.

A stream's keyed state remembers every key that came by: a row of a key passes once, in the batch that brings it first, and
of that batch's rows the earliest capture. Rows don't leave the
JVM. State lies in a RocksDB store beside the checkpoint, dealt by the hash of the key, so a batch reads the state of its own keys and no table. What passes is merged into the table by key, which makes a batch that is repeated
after a failure harmless and touches the partitions of the batch's new rows alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import store

#: The keyed state's store; and Spark refuses any sort in a stream, as it can't order the whole of it. Here only a batch's rows are sorted, within the partitions of the state that reads them.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.unsupportedOperationCheck": "false",
}

_PARTITIONS = "spark.sql.shuffle.partitions"


def _whole(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where(" and ".join(f"`{k}` is not null" for k in keys))


def _order(columns: list[str], by: str) -> list[Column]:
    """The earliest capture, nulls last, ties by all that the row holds."""
    return [F.col(f"`{by}`").asc_nulls_last(), *(F.col(f"`{c}`").cast("string").asc_nulls_last() for c in columns)]


def first_captures(stream: DataFrame, keys: list[str], by: str) -> DataFrame:
    """A streaming frame's rows whose key (no part of it null) no earlier batch held, one for each key: the one with the smallest `by`.

    The state is Spark's own of keys seen, which lets a key's first row pass. Rows are dealt as the state is, so that nothing
    deals them anew between the sort and the state. The query has to start under _SETTINGS and _dealt().
    """
    whole = _whole(stream, keys)
    return whole.repartition(*(F.col(f"`{k}`") for k in keys)).sortWithinPartitions(*_order(whole.columns, by)).dropDuplicates(keys)


def _dealt(spark: SparkSession, checkpoint: str) -> dict[str, str]:
    """The setting by which a checkpoint's state was dealt by its first batch; none before that. Rows dealt otherwise would be dealt anew after they are sorted."""
    fs, log = store._fs(spark, f"{checkpoint}/offsets/[0-9]*")
    for path in store._names(fs, log)[:1]:
        text = "\n".join(r[0] for r in spark.read.text(path.toString()).collect())
        return {_PARTITIONS: n for n in re.findall(rf'"{re.escape(_PARTITIONS)}":"(\d+)"', text)[:1]}
    return {}


def promote_first(spark: SparkSession, raw: str, schema: str, table: str, checkpoint: str, keys: list[str], by: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, partition: str | None = None, files: int = 200, put: Callable[[DataFrame, int], None] | None = None) -> list[dict]:
    """Takes all files under raw that no earlier call took, at most `files` a batch, and puts first captures into the table; put: instead of the table. Gives each batch's progress: number, rows read, keys held, rows that passed."""
    settings = _SETTINGS | _dealt(spark, checkpoint)
    before = {name: spark.conf.get(name, None) for name in settings}
    passed: dict[int, int] = {}

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            passed[number] = batch.count()
            if passed[number]:
                put(batch, number) if put else store.upsert(batch, table, keys, partition, by, True)
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(raw)
    writer = first_captures(prepare(stream), keys, by).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        query = writer.start()  # which keeps the settings
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()
    held = lambda p: sum(s["numRowsTotal"] for s in p["stateOperators"])
    return [{"batch": p["batchId"], "rows_read": p["numInputRows"], "keys_held": held(p), "rows_passed": passed[p["batchId"]]} for p in query.recentProgress if p["batchId"] in passed]


def captured_first(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The same of a frame that isn't a stream."""
    whole = _whole(rows, keys)
    rest = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string")) for c in whole.columns]
    order = F.struct(F.col(by).isNull(), F.col(by), *rest)
    return whole.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in whole.columns)), order).alias("r")).select("r.*")
