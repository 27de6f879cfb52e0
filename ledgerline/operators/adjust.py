"""Split and dividend factors, derived on read. Frames: bars (ticker, date, close, volume, ...), actions (ticker, ex_date, action_type, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Splits of one ratio within so many days after one that was kept are the same split.
SAME_SPLIT_DAYS = 20


def _day(c: str) -> Column:
    return F.unix_date(F.col(c))


def dedupe_splits(actions: DataFrame, days: int = SAME_SPLIT_DAYS) -> DataFrame:
    """(ticker, ex_date, ratio): of splits of one ratio, those over `days` after the last one kept."""
    splits = actions.where("action_type = 'split' and value > 0").select("ticker", F.col("value").alias("ratio"), "ex_date")
    dates = splits.groupBy("ticker", "ratio").agg(F.array_sort(F.collect_set("ex_date")).alias("dates"))
    fold = F.aggregate("dates", F.expr("cast(array() as array<date>)"), lambda kept, d: F.when((F.size(kept) == 0) | (F.datediff(d, F.try_element_at(kept, F.lit(-1))) > days), F.array_append(kept, d)).otherwise(kept))
    return dates.select("ticker", F.explode(fold).alias("ex_date"), "ratio")


def suffix_product(bars: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """(ticker, date, <name>): the product of events' (ticker, ex_date, mult) with ex_date after the bar's date; one sort of both, no range join."""
    both = bars.select("ticker", "date", F.lit(None).cast("double").alias("mult")).unionByName(events.select("ticker", F.col("ex_date").alias("date"), "mult"))
    later = Window.partitionBy("ticker").orderBy((-_day("date"))).rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn(name, F.coalesce(F.product("mult").over(later), F.lit(1.0))).where("mult is null").select("ticker", "date", name)


def dividend_asof(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """(ticker, ex_date, value, prev_close): each dividend with the last close strictly before its date, null if there is none."""
    cash = actions.where("action_type = 'dividend' and value > 0").select("ticker", F.col("ex_date").alias("date"), "value", F.lit(None).cast("double").alias("close"), F.lit(0).alias("kind"))
    rows = bars.select("ticker", "date", F.lit(None).cast("double").alias("value"), "close", F.lit(1).alias("kind")).unionByName(cash)
    before = Window.partitionBy("ticker").orderBy("date", "kind").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("prev_close", F.last("close", ignorenulls=True).over(before))
    return seen.where("kind = 0").select("ticker", F.col("date").alias("ex_date"), "value", "prev_close")


def _with_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """bars with split_factor, div_factor and adj_factor. Bars, splits and dividends share one exchange and two sorts: upwards for each dividend's last close before it, downwards for the products of what comes later."""
    kinds = [("__mult", "double"), ("__cash", "double"), ("__bar", "int")]
    filled = lambda df, **given: df.select("ticker", "date", *(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in bars.schema.fields if f.name not in ("ticker", "date")), *(given.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds))
    own = filled(bars, __bar=F.lit(1), **{c: F.col(c) for c in bars.columns})
    splits = filled(dedupe_splits(actions).withColumnRenamed("ex_date", "date"), __mult=1 / F.col("ratio"), __bar=F.lit(0))
    cash = filled(actions.where("action_type = 'dividend' and value > 0").withColumnRenamed("ex_date", "date"), __cash=F.col("value"), __bar=F.lit(0))
    before = Window.partitionBy("ticker").orderBy("date", "__bar").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("ticker").orderBy(F.desc("date"), F.desc("__bar")).rowsBetween(Window.unboundedPreceding, -1)
    rows = own.unionByName(splits).unionByName(cash).withColumn("__prev", F.last("close", ignorenulls=True).over(before))
    left = 1 - F.try_divide("__cash", "__prev")
    rows = rows.withColumn("__left", F.when(left > 0, left))
    rows = rows.withColumns({"split_factor": F.coalesce(F.product("__mult").over(later), F.lit(1.0)), "div_factor": F.coalesce(F.product("__left").over(later), F.lit(1.0))})
    return rows.where("__bar = 1").drop("__mult", "__cash", "__bar", "__prev", "__left").withColumn("adj_factor", F.col("split_factor") * F.col("div_factor"))


def adjustment_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """(ticker, date, split_factor, div_factor, adj_factor) for each bar."""
    return _with_factors(bars.select("ticker", "date", "close"), actions).drop("close")


def _shares(volume: Column) -> Column:
    """A volume in whole shares; one that no 64-bit number can hold is null."""
    return F.round(volume).try_cast("long")


def _adjusted(rows: DataFrame, prices: tuple[str, ...]) -> DataFrame:
    adj, split = F.coalesce("adj_factor", F.lit(1.0)), F.coalesce("split_factor", F.lit(1.0))
    out = rows.withColumn("close_raw", F.col("close")).withColumns({p: F.col(p) * adj for p in prices} | {"volume": _shares(F.try_divide("volume", split)), "adj_factor": adj})
    return out.drop("split_factor", "div_factor")


def adjusted_view(bars: DataFrame, factors: DataFrame, prices: tuple[str, ...] = ("close",)) -> DataFrame:
    """Bars with adjusted prices and volume by a table of factors; bars without one stay as they are. close_raw keeps the traded close."""
    return _adjusted(bars.join(factors, ["ticker", "date"], "left"), prices)


def adjusted(bars: DataFrame, actions: DataFrame, prices: tuple[str, ...] = ("close",)) -> DataFrame:
    """adjusted_view with factors derived from actions on the way, without a join."""
    return _adjusted(_with_factors(bars, actions), prices)


def as_traded(bars: DataFrame, actions: DataFrame, prices: tuple[str, ...] = ("close",)) -> DataFrame:
    """From split-adjusted bars to prices and volumes as they were traded: the inverse of the split factor."""
    up = suffix_product(bars, dedupe_splits(actions).select("ticker", "ex_date", F.col("ratio").alias("mult")), "up")
    out = bars.join(up, ["ticker", "date"])
    return out.withColumns({p: F.col(p) * F.col("up") for p in prices} | {"volume": _shares(F.try_divide("volume", "up"))}).drop("up")
