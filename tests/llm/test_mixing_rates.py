import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing


def quantile(rate, draw):
    """The number of values whose distribution function isn't above the draw, by masses from the mode outwards."""
    if rate == 0:
        return 0
    mode = int(rate)
    reach = int(14 * math.sqrt(rate)) + 40
    up = np.cumsum(np.log1p((rate - np.arange(mode + 1, mode + reach, dtype=float)) / np.arange(mode + 1, mode + reach, dtype=float)))
    down = np.cumsum(-np.log1p((rate - np.arange(mode, max(0, mode - reach), -1, dtype=float)) / np.arange(mode, max(0, mode - reach), -1, dtype=float)))
    mass = np.exp(np.concatenate((down[::-1], [0.0], up)))
    return mode - len(down) + int(np.searchsorted(np.cumsum(mass) / mass.sum(), draw, side="right"))


@pytest.mark.parametrize("rate", [0.0, 0.01, 1.0, 37.5, 1e6, 1e9])
def test_copies_are_quantiles_at_any_rate(spark, rate):
    n = 300 if rate < 1e8 else 20
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    found = mixing.with_copies(docs, spark.createDataFrame([("s", rate)], "source string, rate double")).toPandas()
    draws = [int(hashlib.md5(f"copies:{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52 for i in found["doc_id"]]
    wanted = [quantile(rate, u) for u in draws]
    # sums of a hundred thousand masses differ in their last digits between engines
    assert sum(a != b for a, b in zip(found["copies"], wanted, strict=True)) <= (3 if rate > 1e5 else 0)
    assert abs(found["copies"] - wanted).max() <= (1 if rate > 1e5 else 0)
    assert abs(found["copies"].mean() - rate) <= 5 * math.sqrt(rate / n) + 1e-9


def test_a_tiny_source_beside_a_large_one(spark):
    """Equal shares repeat one character some 200,000 times."""
    docs = spark.createDataFrame([(1, "x", "small", 0), (2, "y" * 200_000, "large", 0)], "doc_id long, text string, source string, copies int")
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == ["doc_id", "text", "source", "copies", "rate", "replica", "shuffle_key"]
    counts = {r["source"]: (r["n"], r["k"], r["top"]) for r in mixed.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("replica").alias("k"), F.max("replica").alias("top")).collect()}
    n = counts["small"][0]
    assert counts["small"] == (n, n, n) and abs(n - 100_000.5) < 2000


def test_rates_beyond_reach_are_refused(spark):
    docs = spark.createDataFrame([(1, "x", "small"), (2, "yy", "large")], "doc_id long, text string, source string")
    with pytest.raises(ValueError, match="'small' would be repeated"):
        mixing.mix_sources(docs, size=1e12)
