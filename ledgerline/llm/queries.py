"""The corpus operators as queries over the tables of a folder, and what of them DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import compact_windows, context_mixing, hash_tree, language_crf, licenses, line_rules, mixing, no_random_access, packing, q_chunks, quality_trees, setsketch, tsqr


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = setsketch.near_duplicates(_docs(spark, sf_dir), k=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_docs(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "text", "source", F.round("rate", 9).alias("rate"), "replica", "shuffle_key")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality_trees.train(docs, labels.where(~quality_trees.held_out(4, 2)))
    scored = quality_trees.score(docs, model)
    return scored.select("doc_id", quality_trees.held_out(4, 2).alias("held_out"), "score", (F.col("score") >= quality_trees.CUT).cast("int").alias("predicted"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(_docs(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_docs(spark, sf_dir)).drop("matches")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    field = language_crf.train(docs, ~quality_trees.held_out(3, 1))
    found = language_crf.predict(docs, field)
    return found.select("doc_id", quality_trees.held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(_docs(spark, sf_dir), with_text=False)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = context_mixing.score(_docs(spark, sf_dir), quality_trees.held_out(7, 2))
    return found.select("doc_id", quality_trees.held_out(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return no_random_access.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100, k=10)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir))


def op11_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard(_docs(spark, sf_dir))


def op12_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients, vendors = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("clients", "vendors"))
    return q_chunks.name_join(clients, q_chunks.misspelt(vendors))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tsqr.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=4)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_minhash_near_dedup, op2_source_mixing, op3_quality_classifier, op4_substring_dedup, op5_license_scan, op6_language_id, op7_quality_rules, op8_lm_scoring, op9_exact_top_k, op10_packing, op11_hash_tree_sharding, op12_name_join, op13_embedding_whitening)
    return {f.__name__: f for f in own}


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT u, v FROM pairs JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e2 AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r AS (SELECT doc_id, doc_id AS hit FROM documents UNION SELECT r.doc_id, e2.v FROM r JOIN e2 ON r.hit = e2.u),
c AS (SELECT doc_id, min(hit) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_near_dedup": OP1_SQL, "op2_source_mixing": mixing.SQL, "op7_quality_rules": line_rules.SQL, "op9_exact_top_k": no_random_access.SQL, "op11_hash_tree_sharding": hash_tree.SQL, "op12_name_join": q_chunks.SQL}
