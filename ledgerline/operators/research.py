"""Returns, information coefficients, event studies and basket metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _by_date():
    return Window.partitionBy("ticker").orderBy("date")


def forward_returns(closes: DataFrame, horizons: tuple[int, ...] = (1, 5, 20)) -> DataFrame:
    """closes with fwd_<h>: the return over the ticker's own next h sessions; null at the end."""
    return closes.withColumns({f"fwd_{h}": F.try_divide(F.lead("close", h).over(_by_date()), F.col("close")) - 1 for h in horizons})


def average_rank(value: str, *by: str) -> Column:
    """Rank within `by`, ties averaged."""
    group = Window.partitionBy(*by)
    return F.rank().over(group.orderBy(value)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2


def daily_ic(panel: DataFrame, score: str, ret: str, breadth: int = 5, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """(*by, ic, n): rank correlation of score and return on each day with at least `breadth` names, neither side constant."""
    day = Window.partitionBy(*by)
    both = panel.where(F.col(score).isNotNull() & F.col(ret).isNotNull())
    ranked = both.select(*by, average_rank(score, *by).alias("rs"), average_rank(ret, *by).alias("rr"))
    # constant days go before corr(), which would divide by zero
    varied = ranked.withColumns({"n": F.count("*").over(day), "s0": F.min("rs").over(day), "s1": F.max("rs").over(day), "r0": F.min("rr").over(day), "r1": F.max("rr").over(day)}).where(f"n >= {breadth} and s0 < s1 and r0 < r1")
    return varied.groupBy(*by).agg(F.corr("rs", "rr").alias("ic"), F.count("*").alias("n"))


def ic_summary(ics: DataFrame, *by: str) -> DataFrame:
    """(*by, n_days, mean_ic, std_ic, t_stat, icir, hit_rate); null where n or the deviation doesn't allow a number. A coefficient within rounding of 0 is no hit."""
    out = ics.groupBy(*by).agg(F.count("ic").alias("n_days"), F.avg("ic").alias("mean_ic"), F.stddev_samp("ic").alias("std_ic"), F.avg((F.round("ic", 9) > 0).cast("double")).alias("hit_rate"))
    ratio = F.try_divide(F.col("mean_ic"), F.nullif("std_ic", F.lit(0.0)))
    return out.withColumns({"icir": ratio, "t_stat": ratio * F.sqrt("n_days")})


def ic_decay(factor: DataFrame, closes: DataFrame, score: str, horizons: tuple[int, ...] = (1, 5, 20), breadth: int = 5) -> DataFrame:
    """IC summary for each horizon, in one job."""
    ahead = forward_returns(closes, horizons).unpivot(["ticker", "date"], [f"fwd_{h}" for h in horizons], "name", "ret").withColumn("horizon", F.substring_index("name", "_", -1).cast("int"))
    panel = factor.select("ticker", "date", score).join(ahead, ["ticker", "date"])
    return ic_summary(daily_ic(panel, score, "ret", breadth, ("horizon", "date")), "horizon")


def find_events(factor: DataFrame, score: str, threshold: float, least: int = 1) -> DataFrame:
    """(ticker, date, sign): extreme scores with enough articles."""
    hits = factor.where((F.abs(score) >= threshold) & (F.col("n_articles") >= least) & (F.col(score) != 0))
    return hits.select("ticker", "date", F.signum(score).cast("int").alias("sign"))


def event_study(closes: DataFrame, events: DataFrame, pre: int = 5, post: int = 20) -> DataFrame:
    """(sign, offset, n_events, mean_ar, car): mean abnormal return (less the day's mean) around events whose window is complete, and its running sum."""
    ret = closes.withColumn("ret", F.try_divide(F.col("close"), F.lag("close").over(_by_date())) - 1).withColumn("i", F.row_number().over(_by_date()))
    panel = ret.withColumn("ar", F.col("ret") - F.avg("ret").over(Window.partitionBy("date"))).select("ticker", "date", "i", "ar")
    size = panel.withColumn("last", F.max("i").over(Window.partitionBy("ticker")))
    marked = events.join(size.select("ticker", "date", "i", "last"), ["ticker", "date"]).where((F.col("i") > pre) & (F.col("i") + post <= F.col("last")))
    # each event asks for its offsets by ordinal, so the join is on equal keys
    asked = marked.select("ticker", "sign", F.col("i").alias("at"), F.explode(F.sequence(F.lit(-pre), F.lit(post))).alias("offset")).withColumn("i", F.col("at") + F.col("offset"))
    means = asked.join(panel.select("ticker", "i", "ar"), ["ticker", "i"]).groupBy("sign", "offset").agg(F.count("*").alias("n_events"), F.avg("ar").alias("mean_ar"))
    return means.withColumn("car", F.sum("mean_ar").over(Window.partitionBy("sign").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)))


def basket_metrics(closes: DataFrame, names: list[str]) -> DataFrame:
    """One row a name at its last bar: close, ret_5, ret_20, distances to SMA 20 and 50, RSI 14 (simple means), strength against the basket's median ret_20."""
    rows = closes.where(F.col("ticker").isin(names))
    back = lambda n: F.try_divide(F.col("close"), F.lag("close", n).over(_by_date())) - 1
    tail = lambda n: _by_date().rowsBetween(1 - n, 0)
    sma = lambda n: F.when(F.count("close").over(tail(n)) == n, F.try_divide(F.col("close"), F.avg("close").over(tail(n))) - 1)
    rows = rows.withColumn("d", F.col("close") - F.lag("close").over(_by_date()))
    up, down = F.avg(F.greatest("d", F.lit(0.0))).over(tail(14)), F.avg(F.greatest(-F.col("d"), F.lit(0.0))).over(tail(14))
    rsi = F.when(F.count("d").over(tail(14)) == 14, F.when(down == 0, 100.0).otherwise(100 - F.try_divide(F.lit(100.0), 1 + F.try_divide(up, down))))
    full = rows.withColumns({"ret_5": back(5), "ret_20": back(20), "dist_sma_20": sma(20), "dist_sma_50": sma(50), "rsi_14": rsi, "rn": F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))})
    last = full.where("rn = 1").select("ticker", "date", "close", "ret_5", "ret_20", "dist_sma_20", "dist_sma_50", "rsi_14")
    middle = last.agg(F.median("ret_20").alias("middle"))
    return last.join(F.broadcast(middle)).withColumn("rel_strength", F.col("ret_20") - F.col("middle")).drop("middle")


def momentum(closes: DataFrame) -> DataFrame:
    """At each name's last bar: returns over 21, 63, 126 and 252 bars and the distance to the 252-bar high."""
    cols = {f"mom_{n}": F.try_divide(F.col("close"), F.lag("close", n).over(_by_date())) - 1 for n in (21, 63, 126, 252)}
    high = F.try_divide(F.col("close"), F.max("close").over(_by_date().rowsBetween(-251, 0))) - 1
    rows = closes.withColumns(cols | {"dist_high": high, "rn": F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))})
    return rows.where("rn = 1").select("ticker", "date", "close", *cols, "dist_high")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bounded(rows: DataFrame, first=None, last=None, tickers: list[str] | None = None) -> DataFrame:
    """Rows of some tickers within [first, last]; None sets no bound."""
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("date") <= F.lit(last).cast("date"))
    return rows if tickers is None else rows.where(F.col("ticker").isin(tickers))


def latest(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """(key, order, columns) of each key's last row; ties go to the largest columns."""
    return rows.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("__last")).select(key, "__last.*")


def sample_sizes(panel: DataFrame) -> DataFrame:
    """One row: how many days and tickers a panel has."""
    return panel.agg(F.countDistinct("date").alias("n_dates"), F.countDistinct("ticker").alias("n_tickers"))
