"""The lake: immutable raw payloads, versioned curated tables with upsert by key, and append-only logs.

A curated table is a folder of data and a log of numbered versions. A version is a small file that names the folders, one
for each partition, which make up the table, and its schema. A writer writes new folders for the partitions that it
touches, then adds the next number: readers see one version or the other, untouched partitions are neither read nor
written, and a writer that dies leaves the last version as it was. Of two writers at once the later one fails and can be repeated.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.dedupe import first_wins, latest_wins, total_order


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def merged(existing: DataFrame, incoming: DataFrame, keys: list[str], first: bool = False) -> DataFrame:
    """Incoming rows, and existing ones whose key doesn't come in. first: the other way round, what was captured first stays."""
    if first:
        return existing.unionByName(incoming.join(existing.select(*keys).distinct(), keys, "left_anti").select(incoming.columns), allowMissingColumns=True)
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").select(existing.columns).unionByName(incoming, allowMissingColumns=True)


def write_raw(df: DataFrame, root: str, provider: str, dataset: str, run_id: str) -> str:
    """Appends a payload under its own run folder; a folder that is there already is an error."""
    path = f"{root}/raw/provider={provider}/dataset={dataset}/run_id={run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _names(fs, pattern) -> list:
    return [x.getPath() for x in fs.globStatus(pattern) or []]


def current(spark: SparkSession, table: str) -> tuple[int, dict]:
    """(number, version) of the table's newest version; (0, {}) if there is none. A version: schema, and parts by partition folder."""
    fs, log = _fs(spark, f"{table}/_log/[0-9]*")
    numbers = [int(p.getName()) for p in _names(fs, log)]
    if not numbers:
        return 0, {}
    last = max(numbers)
    return last, json.loads("".join(r[0] for r in spark.read.text(f"{table}/_log/{last:020d}", wholetext=True).collect()))


def _read(spark: SparkSession, table: str, version: dict, parts: dict[str, str]) -> DataFrame:
    schema = StructType.fromJson(version["schema"])
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{table}/data").parquet(*(f"{table}/data/{p}" for p in parts.values())).select(schema.names)


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """The newest version; a table that isn't there is empty. Rows written before a column came hold null in it."""
    _, version = current(spark, table)
    if version:
        return _read(spark, table, version, version["parts"])
    return spark.createDataFrame([], schema or "none string")


def upsert(df: DataFrame, table: str, keys: list[str], partition: str | None = None, by: str | None = None, first: bool = False) -> dict[str, int]:
    """Merges df by key, incoming rows winning; of incoming rows with one key the last by `by` and then by all columns stays. Gives rows_in, rows_new and rows_replaced.

    first: the first capture wins instead, both among incoming rows and against those that are there.

    partition: a column that the key determines (the year of its date); only partitions that have incoming rows are
    read and written anew. Its distinct values are held on the driver, as are the names of the table's partitions.
    """
    spark = df.sparkSession
    order = total_order(df, keys, by)
    incoming = ((first_wins if first else latest_wins)(df, keys, order[0], order[1:]) if order else df.distinct()).persist()
    try:
        values = [r[0] for r in incoming.select(partition).distinct().collect()] if partition else []
        n = incoming.count()
        if not n:
            return {"rows_in": 0, "rows_new": 0, "rows_replaced": 0}
        number, old = current(spark, table)
        held, out = 0, incoming
        if old:
            before = _read(spark, table, old, old["parts"])
            if partition:
                touched = F.col(partition).isin([v for v in values if v is not None])
                before = before.where(touched | F.col(partition).isNull() if None in values else touched)
            held, out = before.count(), merged(before, incoming, keys, first)
        name = uuid.uuid4().hex
        # the hint lets a large partition have many writers and small ones share one
        spread = out.hint("rebalance", partition).sortWithinPartitions(partition, *keys) if partition else out.hint("rebalance").sortWithinPartitions(*keys)
        cols = [partition, "__v"] if partition else ["__v"]
        spread.withColumn("__v", F.lit(name)).write.partitionBy(*cols).mode("append").parquet(f"{table}/data")
        fs, found = _fs(spark, f"{table}/data/{'*/' if partition else ''}__v={name}")
        parts = {p.getParent().getName() if partition else "": f"{p.getParent().getName()}/{p.getName()}" if partition else p.getName() for p in _names(fs, found)}
        version = {"schema": out.schema.jsonValue(), "parts": (old.get("parts", {}) if partition else {}) | parts}
        written = _read(spark, table, version, parts).count()
        _commit(spark, table, number + 1, version)
        return {"rows_in": n, "rows_new": written - held, "rows_replaced": 0 if first else held + n - written}
    finally:
        incoming.unpersist()


def _commit(spark: SparkSession, table: str, number: int, version: dict) -> None:
    """Adds a version under a number that nobody has taken: the whole file first, under another name, then a rename."""
    fs, fresh = _fs(spark, f"{table}/_log/.{uuid.uuid4().hex}")
    stream = fs.create(fresh, False)
    stream.write(bytearray(json.dumps(version).encode()))
    stream.close()
    _, there = _fs(spark, f"{table}/_log/{number:020d}")
    if fs.exists(there) or not fs.rename(fresh, there):
        fs.delete(fresh, False)
        raise RuntimeError(f"another writer made version {number} of {table}; repeat the upsert")


def vacuum(spark: SparkSession, table: str) -> int:
    """Removes data that the newest version doesn't name, and gives the number of folders; only while nobody writes or reads an older version."""
    _, version = current(spark, table)
    keep, gone = set(version.get("parts", {}).values()), 0
    for pattern, depth in ((f"{table}/data/__v=*", 1), (f"{table}/data/*/__v=*", 2)):
        fs, found = _fs(spark, pattern)
        for path in _names(fs, found):
            name = path.getName() if depth == 1 else f"{path.getParent().getName()}/{path.getName()}"
            if name not in keep:
                fs.delete(path, True)
                gone += 1
    return gone


def append_log(df: DataFrame, log: str) -> None:
    """Watermarks, manifests and ledgers are logs; readers take the latest row of a key."""
    df.write.mode("append").parquet(log)


def pending_files(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Raw files (path) that the ledger (path) doesn't hold."""
    return files if ledger is None else files.join(ledger.select("path").distinct(), "path", "left_anti")
