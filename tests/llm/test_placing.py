import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hash_tree, tsqr


def numbers(spark, n):
    return spark.range(n).withColumnRenamed("id", "doc_id").withColumn("text", F.concat(F.lit("text "), F.col("doc_id") % 7))


def test_shards_of_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", "b"), (None, "é☃", "c"), (None, "é☃", "c"), (None, None, None), (3, "x" * 300_000, "d"), (4, "\n", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot string").withColumn("shard", F.lit(99)).withColumn("copies", F.lit(1))
    found = hash_tree.shard(docs).toPandas()
    assert sorted((r.size, r.text_crc32) for r in found.itertuples()) == sorted((1 + len((t or "").encode()), zlib.crc32((t or "").encode())) for _, t, _ in rows)
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert hash_tree.shard(docs.where("false")).count() == 0
    placed = hash_tree.place(docs)
    assert placed.columns == [*docs.columns, "law", "grown_shard"]
    assert placed.where("shard = 99").count() == 0


def test_slots_have_no_gaps_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(hash_tree, "BUCKET_ROWS", 100)
    found = hash_tree.shard(numbers(spark, 5000).unionByName(spark.range(2500).selectExpr("cast(null as long) doc_id", "'copy' text"))).toPandas()
    assert len(found) == 7500
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    again = hash_tree.shard(numbers(spark, 5000).repartition(7).unionByName(spark.range(2500).selectExpr("cast(null as long) doc_id", "'copy' text"))).toPandas()
    order = lambda f: sorted(map(tuple, f.astype(object).where(f.notna(), None).values.tolist()), key=str)
    assert order(found) == order(again)


def test_a_shard_more_takes_rows_only_into_itself(spark):
    found = hash_tree.place(numbers(spark, 40_000)).select("shard", "grown_shard").toPandas()
    moved = found[found["shard"] != found["grown_shard"]]
    assert set(moved["grown_shard"]) == {8}
    assert abs(len(moved) / 40_000 - 1 / 9) < 0.01
    assert all(abs(c / 40_000 - 1 / 8) < 0.01 for c in Counter(found["shard"]).values())
    tree = hash_tree.grow(hash_tree.even_tree(), 8)
    again = hash_tree.place(numbers(spark, 40_000), tree, hash_tree.grow(tree, 9, 3.0)).select("shard", "grown_shard").toPandas()
    assert set(again.loc[again["shard"] != again["grown_shard"], "grown_shard"]) == {9}
    assert abs((again["grown_shard"] == 9).mean() - 3 / 12) < 0.01


def test_moves_stay_in_subtrees_whose_weights_change(spark):
    tree = hash_tree.even_tree()
    # rack0's weight moves from shard 0 to shard 1: nothing beside that rack may move
    inside = {**tree, "region0": {**tree["region0"], "rack0": {0: 0.5, 1: 1.5}}}
    # rack0 loses weight: keys leave it, none moves between the others' shards but for those that come from it
    less = {**tree, "region0": {**tree["region0"], "rack0": {0: 0.5, 1: 0.5}}}
    rows = hash_tree.place(numbers(spark, 20_000), tree, inside).select("shard", "grown_shard").toPandas()
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert len(moved) and set(moved["shard"]) == {0} and set(moved["grown_shard"]) == {1}
    rows = hash_tree.place(numbers(spark, 20_000), tree, less).select("shard", "grown_shard").toPandas()
    moved = rows[rows["shard"] != rows["grown_shard"]]
    # region0 weighs 3 of 7 now: keys leave it from rack0 and from rack1, and inside it go from rack0 to rack1; none enters it
    assert set(moved["shard"]) <= {0, 1, 2, 3} and not set(moved["grown_shard"]) & {0, 1}
    assert abs((rows["grown_shard"] >= 4).mean() - 4 / 7) < 0.02


def test_weights_are_checked():
    for tree in ({"r": {"k": {0: 0.0}}}, {"r": {"k": {0: -1.0, 1: 2.0}}}, {"r": {"k": {0: 1.0}, "l": {0: 1.0}}}, {}):
        with pytest.raises(ValueError):
            hash_tree.shard_of(F.lit("x"), tree)
    with pytest.raises(ValueError):
        hash_tree.grow(hash_tree.even_tree(), 3)


def test_shards_are_written_whole(spark, tmp_path):
    docs = numbers(spark, 300)
    hash_tree.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("doc_id", "text", "shard").collect()) == sorted(hash_tree.place(docs).select("doc_id", "text", "shard").collect())


def brute(vectors, k=4):
    """Eigenvectors of the fit list's covariance, formed in full."""
    x = [tuple(int(np.floor(256.0 * float(c))) for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    own = np.array([[float(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    deviation = [sum(int(n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return n, deviation, own @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


@pytest.mark.parametrize("parts", [1, 40])
def test_whitening_against_full_covariance(spark, parts, monkeypatch):
    monkeypatch.setattr(tsqr, "FAN", 3)
    r = np.random.default_rng(5)
    base = (r.normal(size=(600, 9)) * [5, 3, 2, 1.2, 0.4, 0.2, 0.1, 0.05, 0.0]) @ np.linalg.qr(r.normal(size=(9, 9)))[0] + 40
    vectors = np.concatenate((base, base[:50], np.repeat(base[:1], 200, axis=0))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), "z") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, n string").repartition(parts)
    found = tsqr.whiten(rows).toPandas().sort_values(["vec_id", "component"])
    n, deviation, whitened, explained = brute(vectors)
    assert len(found) == len(vectors) * 4 and set(found["n"]) == {n}
    assert found["deviation"].tolist() == [d for d in deviation for _ in range(4)]
    mine = found["whitened"].to_numpy().reshape(-1, 4)
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.allclose(mine, whitened * signs, atol=1e-8)
    assert np.allclose(found["explained"].to_numpy().reshape(-1, 4), explained, rtol=1e-9)
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 2.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [2.0, 0.0]), (8, [-1.0, 0.5]), (9, [1.0, 1.0, 1.0]), (10, [1e300, -1e300, 0.0, 1.0]), (11, [0.0, 0.0, 0.0, 0.0])]
    found = tsqr.whiten(spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, component int")).toPandas()
    # lengths 2 (3 distinct vectors, 2 components), 3 (one vector: none) and 4 (2 vectors: 1 component)
    assert sorted(found["vec_id"].fillna(-1)) == [-1, -1, 6, 6, 6, 6, 7, 7, 8, 8, 10, 11]
    assert set(found.loc[found["vec_id"] == 6, "n"]) == {3}
    assert found["identity_error"].max() < 1e-9
    assert found.loc[found["vec_id"] == 10, "deviation"].iloc[0] == (1 << 63) - 1
    assert tsqr.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_small_variances_keep_their_digits(spark):
    """Deviations of 1 beside ones of 2**28: the covariance's square would leave nothing of the small one."""
    r = np.random.default_rng(2)
    x = np.column_stack((np.round(r.normal(size=400) * 2.0**28), np.round(r.normal(size=400) * 3)))
    x[:, 1] += 0.0
    turned = np.column_stack((x[:, 0], x[:, 0] + x[:, 1]))
    rows = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(turned)], "vec_id long, embedding array<double>")
    assert tsqr.whiten(rows).toPandas()["identity_error"].max() < 1e-6
