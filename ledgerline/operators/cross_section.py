"""Statistics over all names of one date: exact percent ranks, z-scores and winsorised z-scores, however many names a date has.

Ranks don't sort a date in one task. The values of a date that has many are put into bins by approximate percentiles; how many
rows lie below a bin comes from a small table of counts, and only the values of one bin are put in order together, so that ranks are
exact wherever the bins' bounds fall. Quantiles are exact, too: they are order statistics, which the ranks name. What is known of a
date is joined to its rows by the date and a share of SPREAD, so that one date's rows go to many tasks.

Null, NaN and infinite values take no part and have null results; rows without a date are those of one date.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.asof import same_keys, slices

#: Distinct values that a bin holds about, and shares into which a date's rows are dealt.
BIN_ROWS, SPREAD = 200_000, 32


def _kept(df: DataFrame) -> DataFrame:
    """df with its lineage cut, in the folder that spark.checkpoint.dir names; in local mode without one, in a folder of our own."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if there := spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(there)
    elif sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
    return df.checkpoint()


def _with_known(rows: DataFrame, known: DataFrame, keys: list[str], how: str, deal: Column | None = None) -> DataFrame:
    """rows with the columns of known (one row for each value of keys, nulls being equal). deal: joined over shares of the rows by its hash, where a key may have very many rows."""
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    shares = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))) if deal is not None else F.lit(0)
    small = known.select(*(F.col(k).alias(n) for k, n in names.items()), *(c for c in known.columns if c not in keys), shares.alias("__share"))
    on = F.pmod(F.xxhash64(deal), F.lit(SPREAD)) == F.col("__share") if deal is not None else F.lit(True)
    for k, n in names.items():
        on = on & F.col(k).eqNullSafe(F.col(n))
    return rows.join(small, on, how).drop("__share", *names.values())


def _finite(value: str) -> Column:
    v = F.col(value).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def percent_ranks(rows: DataFrame, value: str, by: str = "date", bin_rows: int = BIN_ROWS) -> DataFrame:
    """(by, value, n, below, equal, rank_share): for each distinct value of each date how many of the date's n rows lie below it and how many have it, and below over n - 1 (0 for a single row)."""
    counted = _kept(rows.where(_finite(value)).groupBy(F.col(by).alias("d"), (F.col(value).cast("double") + F.lit(0.0)).alias("v")).agg(F.count("*").alias("equal")))
    bounds = F.broadcast(slices(counted.withColumnRenamed("v", "__t"), ["d"], bin_rows))
    bin_ = F.when(F.col("__bounds").isNull(), 0).otherwise(F.size(F.filter("__bounds", lambda x: x < F.col("v"))))
    binned = counted.join(bounds, same_keys(["d"]), "left").select("d", "v", "equal", bin_.cast("int").alias("bin"))
    sizes = binned.groupBy("d", "bin").agg(F.sum("equal").alias("rows"))
    order = Window.partitionBy("d").orderBy("bin")
    before = sizes.select("d", "bin", (F.sum("rows").over(order) - F.col("rows")).alias("before"), F.sum("rows").over(Window.partitionBy("d")).alias("n"))
    inside = Window.partitionBy("d", "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _with_known(binned.withColumn("upto", F.sum("equal").over(inside)), before, ["d", "bin"], "inner")
    below = F.col("before") + F.col("upto") - F.col("equal")
    share = F.when(F.col("n") > 1, below / (F.col("n") - 1)).otherwise(0.0)
    return placed.select(F.col("d").alias(by), F.col("v").alias(value), "n", below.alias("below"), "equal", share.alias("rank_share"))


def quantiles(ranks: DataFrame, value: str, shares: list[float], by: str = "date") -> DataFrame:
    """(by, q0, q1, ...): exact quantiles of each date from its percent ranks, interpolated between neighbouring order statistics."""
    place = lambda q: F.lit(q) * (F.col("n") - 1)
    at = lambda p: F.max(F.when((F.col("below") <= p) & (p < F.col("below") + F.col("equal")), F.col(value)))
    sums = ranks.groupBy(by).agg(F.max("n").alias("n"), *(c for i, q in enumerate(shares) for c in (at(F.floor(place(q))).alias(f"__a{i}"), at(F.ceil(place(q))).alias(f"__b{i}"))))
    part = lambda q: place(q) - F.floor(place(q))
    return sums.select(by, *((F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * part(q)).alias(f"q{i}") for i, q in enumerate(shares)))


def _moments(x: Column, shift: Column, name: str) -> list[Column]:
    """Weighted by `equal`: the mean and the sample deviation, from sums of what x differs from a value near it."""
    n, one, two = F.sum("equal"), F.sum((x - shift) * F.col("equal")), F.sum((x - shift) * (x - shift) * F.col("equal"))
    spread = F.try_divide(two - one * one / n, n - 1)
    # a spread that rounding alone may have left is none
    return [(F.first(shift) + one / n).alias(f"{name}_mean"), F.when(spread > 1e-14 * two / n, F.sqrt(spread)).alias(f"{name}_dev")]


def scores(rows: DataFrame, value: str, by: str = "date", tails: float = 0.01, bin_rows: int = BIN_ROWS) -> DataFrame:
    """rows with n, rank_share, z and z_winsor: how many values the date has, the percent rank among them, the z-score, and the z-score of values drawn in to the date's `tails` and 1 - `tails` quantiles.

    Deviations are sample deviations; a date of one row or without spread has null scores.
    """
    ranks = _kept(percent_ranks(rows, value, by, bin_rows))
    known = _with_known(ranks, quantiles(ranks, value, [tails, 1 - tails], by), [by], "inner", F.col(value))
    drawn = F.greatest(F.least(F.col(value), F.col("q1")), F.col("q0"))
    sums = known.groupBy(by).agg(*_moments(F.col(value), F.col("q0"), "all"), *_moments(drawn, F.col("q0"), "drawn"), F.first("q0").alias("q0"), F.first("q1").alias("q1"))
    own = F.when(_finite(value), F.col(value).cast("double") + F.lit(0.0))
    r = ranks.select(F.col(by).alias("__d"), F.col(value).alias("__v"), "n", "rank_share")
    joined = rows.withColumn("__own", own).join(r, F.col(by).eqNullSafe(F.col("__d")) & (F.col("__own") == F.col("__v")), "left")
    joined = _with_known(joined, sums, [by], "left", F.col("__own"))
    z = F.try_divide(F.col("__own") - F.col("all_mean"), "all_dev")
    zw = F.try_divide(F.greatest(F.least(F.col("__own"), F.col("q1")), F.col("q0")) - F.col("drawn_mean"), "drawn_dev")
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns), "n", "rank_share", F.when(F.col("__own").isNotNull(), z).alias("z"), F.when(F.col("__own").isNotNull(), zw).alias("z_winsor"))
