"""A corpus from raw documents to packed sequences: five stages, each over all that the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of docs, the last one the pieces of packed
sequences. Null texts are treated as empty ones and null ids pass through, as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import compact_windows, mixing, packing, quality_trees, setsketch
from ledgerline.llm._spark import Stash, chunks, map_arrow, sized, texts_of


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality_trees.train(docs, labels.where(~quality_trees.held_out(4, 2)))
    cols = docs.columns
    inner = docs.toDF(*(c if c == "text" else f"c{i}" for i, c in enumerate(cols)))

    def run(batches):
        for batch in chunks(batches):
            good = quality_trees.predict(model, quality_trees.statistics(texts_of(batch))) >= quality_trees.CUT
            yield batch.filter(pa.array(np.asarray(good, bool)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields)
    return map_arrow(inner, run, schema).toDF(*cols)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, a similarity of 0.8), the one with the smallest doc_id.

    Rows without a doc_id or without words stay, as does the text of a doc_id that other rows hold with other words.
    """
    cols = docs.columns
    known = docs.where("doc_id is not null")
    if not known.groupBy("doc_id").count().where("count > 1").limit(1).count():
        found = Stash(setsketch.near_duplicates(docs, k=5, percent=80).where("doc_id <> component_id").select("doc_id"))
        return docs.join(sized(found.read()), "doc_id", "left_anti").select(cols)
    # a doc_id of several rows doesn't name a document: rows are compared under numbers of their own
    row = next(name for name in ("row", *(f"row_{i}" for i in range(len(cols)))) if name not in cols)
    numbered = Stash(docs.withColumn(row, F.monotonically_increasing_id()))
    found = setsketch.near_duplicates(numbered.read().where("doc_id is not null").select(F.col(row).alias("doc_id"), "text"), k=5, percent=80)
    found = Stash(found.withColumnRenamed("doc_id", row).join(numbered.read().select(row, "doc_id"), row))
    kept = found.read().groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias("kept")).select(F.col(f"kept.{row}").alias("own"))
    gone = Stash(found.read().join(kept, F.col(row) == F.col("own"), "left_anti").select(row))
    return numbered.read().join(sized(gone.read()), row, "left_anti").select(cols)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds."""
    return compact_windows.remove_passages(docs, compact_windows.repeated_passages(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have equal shares."""
    return mixing.mix_sources(docs).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", source_mixing),
    ("packing", packed),
]

#: The classifier's trees, the sketches and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = Stash(stage(spark, docs, sf_dir)).read()
    return STAGES[-1][1](spark, docs, sf_dir)
