"""Plumbing shared by the corpus operators: intermediate tables, sized broadcasts, Arrow batches, labels of connected parts."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import sys
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of narrow tables (ids, counts) up to which a side is broadcast after it has been counted.
BROADCAST_ROWS = 500_000
#: Rows that one file of a narrow table holds about, and the least number of files.
FILE_ROWS, LEAST_FILES = 100_000, 6
#: Bytes of text that one numpy pass takes at a time.
CHUNK_BYTES = 1 << 20

#: Rows of an Arrow batch: texts of some kilobytes each would otherwise fill tens of megabytes on both sides of the pipe.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a folder of our own."""
    if there := spark.conf.get("spark.checkpoint.dir", None):
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="ledgerline-"))
    return _own_dir[0]


_shipped: set[str] = set()


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow, with this package sent to the executors first, which need not have it installed."""
    sc = df.sparkSession.sparkContext
    if df.sparkSession.conf.get(_BATCH, "10000") == "10000":  # Spark's default; a setting of the user's stays
        df.sparkSession.conf.set(_BATCH, str(BATCH_ROWS))
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline_package.zip")
        atexit.register(shutil.rmtree, target.parent, ignore_errors=True)
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        sc.addPyFile(str(target))

    def task(batches):
        yield from run(batches)
        release()

    return df.mapInArrow(task, schema)


def release() -> None:
    """Gives memory that is free, but held by Arrow's pool and the C library, back to the system: workers live on after a task."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in some C libraries
        if trim is not None:
            trim(0)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove_late(spark: SparkSession, path: str) -> None:
    try:
        _remove(spark, path)
    except Exception:  # the session ended first; the folder's owner clears it  # noqa: BLE001
        return


class Stash:
    """A table written to the shared folder, which cuts lineage and outlives executors. rows: about how many narrow rows there are at most, for as few files as they need."""

    def __init__(self, df: DataFrame, rows: int | None = None):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/stash-{uuid.uuid4().hex}"
        self.schema = df.schema
        (df if rows is None else df.coalesce(max(LEAST_FILES, -(-rows // FILE_ROWS)))).write.parquet(self.path)
        atexit.register(_remove_late, self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        _remove(self.spark, self.path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; beyond that Spark shuffles. df: narrow and cheap to count (a stash)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def chunks(batches, column: str = "text", size: int = CHUNK_BYTES):
    """Slices of Arrow batches with about `size` bytes of text each, in order; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0))
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch, column: str = "text") -> list[bytes]:
    """Each text's UTF-8 bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def components(edges: DataFrame, rows: int) -> DataFrame:
    """(id, comp): every id that has an edge (u, v), with the smallest id of its connected part. rows: about how many edges there are at most.

    Each round every part joins the neighbour that comes first in an order drawn anew (a random order
    makes chains shrink by a constant factor), and links inside a part go. Rounds end when no link is left.
    """
    live = Stash(edges.select("u", "v").where("u <> v").distinct(), rows)
    ids = Stash(live.read().select(F.explode(F.array("u", "v")).alias("id")).distinct().withColumn("comp", F.col("id")), rows)
    turn = 0
    while count := live.read().count():
        turn += 1
        rank = lambda c, n=turn: F.struct(F.xxhash64(F.lit(n), c).alias("r"), F.col(c).alias("id"))
        both = live.read().select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.*")
        to = Stash(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(rank("a"), "m")["id"].alias("p")), count)
        up = sized(to.read())
        new = Stash(ids.read().join(up, F.col("comp") == F.col("a"), "left").select("id", F.coalesce("p", "comp").alias("comp")), rows)
        moved = live.read().join(up.withColumnsRenamed({"a": "ua", "p": "up"}), F.col("u") == F.col("ua")).join(up.withColumnsRenamed({"a": "va", "p": "vp"}), F.col("v") == F.col("va"))
        left = Stash(moved.where("up <> vp").select(F.least("up", "vp").alias("u"), F.greatest("up", "vp").alias("v")).distinct(), count)
        for old in (live, ids, to):
            old.drop()
        live, ids = left, new
    least = ids.read().groupBy("comp").agg(F.min("id").alias("least"))
    return ids.read().join(least, "comp").select("id", F.col("least").alias("comp"))
