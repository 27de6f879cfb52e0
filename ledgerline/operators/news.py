"""News: markets, attribution to sessions, daily sentiment, decay, feed parsing, intraday segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Suffix, time zone, calendar, last second of the day that still counts for the same session.
MARKETS = [(".HK", "Asia/Hong_Kong", "XHKG", "15:30:00"), (".KS", "Asia/Seoul", "XKRX", "15:00:00"), (".KQ", "Asia/Seoul", "XKRX", "15:00:00")]
#: Fields of a feed's articles.
FEED = "title string, url string, time_published string, summary string, source string, overall_sentiment_score double, ticker_sentiment array<struct<ticker:string,relevance_score:string,ticker_sentiment_score:string>>"
DEFAULT_MARKET = ("America/New_York", "XNYS", "15:30:00")


def market(ticker: str = "ticker", default: tuple[str, str, str] = DEFAULT_MARKET) -> tuple[Column, Column, Column]:
    """(time zone, calendar, cutoff) of a ticker by its suffix, in upper or lower case."""
    out = []
    for i in range(3):
        c = F.lit(default[i])
        for suffix, *rest in reversed(MARKETS):
            c = F.when(F.upper(ticker).endswith(suffix), F.lit(rest[i])).otherwise(c)
        out.append(c)
    return tuple(out)


def trading_day(rows: DataFrame, calendar_map: DataFrame, instant: str = "effective_ts", default: tuple[str, str, str] = DEFAULT_MARKET) -> DataFrame:
    """rows with date: the local session of the instant (UTC) if its local time isn't after the cutoff, else the next session."""
    zone, name, cutoff = market("ticker", default)
    local = rows.withColumns({"__local": F.from_utc_timestamp(instant, zone), "__cal": name, "__cut": cutoff})
    days = calendar_map.select(F.col("calendar").alias("__c"), F.col("any_date").alias("__d"), "is_session", "next_session")
    joined = local.join(days, (F.col("__cal") == F.col("__c")) & (F.to_date("__local") == F.col("__d")), "left")
    same = F.col("is_session") & (F.date_format("__local", "HH:mm:ss") <= F.col("__cut"))
    return joined.withColumn("date", F.when(same, F.col("__d")).otherwise(F.col("next_session"))).drop("__local", "__cal", "__cut", "__c", "__d", "is_session", "next_session")


def effective(rows: DataFrame) -> DataFrame:
    """effective_ts: the later of publication and capture, so late captures are never dated back."""
    return rows.withColumn("effective_ts", F.greatest("published_at", "ingested_at"))


def sentiment_daily(rows: DataFrame, floor: float = 0.25, scores: tuple[str, ...] = ("score_av",)) -> DataFrame:
    """(ticker, date, sent..., n_articles, log_n_articles, rel_sum): relevance-weighted means over scored articles; a null relevance weighs 1."""
    w = rows.withColumn("w", F.coalesce("relevance", F.lit(1.0))).where(F.col("w") >= floor)
    mean = lambda s: F.try_divide(F.sum(F.when(F.col(s).isNotNull(), F.col(s) * F.col("w"))), F.sum(F.when(F.col(s).isNotNull(), F.col("w"))))
    out = w.groupBy("ticker", "date").agg(*(mean(s).alias("sent_" + s.split("_", 1)[1]) for s in scores), F.countDistinct("article_id").alias("n_articles"), F.sum("w").alias("rel_sum"))
    return out.withColumn("log_n_articles", F.log1p("n_articles"))


def decayed(spine: DataFrame, factor: DataFrame, score: str, tau: float = 5.0) -> DataFrame:
    """(ticker, date, last_score, days_since, decayed): the last score seen, fading with the days since the last observation."""
    run = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    obs = factor.select("ticker", "date", score, F.col("date").alias("obs_date"))
    rows = spine.select("ticker", "date").distinct().join(obs, ["ticker", "date"], "left")
    seen = rows.withColumns({"last_score": F.last(score, ignorenulls=True).over(run), "days_since": F.datediff("date", F.max("obs_date").over(run))})
    return seen.select("ticker", "date", "last_score", "days_since", (F.col("last_score") * F.exp(-F.col("days_since") / tau)).alias("decayed"))


def parse_feed(feed: DataFrame, provider: str) -> DataFrame:
    """One row for each article and ticker of a feed (title, url, time_published, ..., ticker_sentiment array); articles without tickers keep one row. No url or no valid time: dropped."""
    a = feed.withColumns({"published_at": F.try_to_timestamp("time_published", F.lit("yyyyMMdd'T'HHmmss"))}).where("url is not null and url <> '' and published_at is not null")
    t = a.select("*", F.explode_outer("ticker_sentiment").alias("t"))
    return t.select(
        F.sha2("url", 256).alias("article_id"), "published_at", F.lit(provider).alias("provider"), "source", "title", "summary", "url", "overall_sentiment_score",
        F.nullif(F.upper("t.ticker"), F.lit("")).alias("ticker"), F.expr("try_cast(t.relevance_score as double)").alias("relevance"), F.expr("try_cast(t.ticker_sentiment_score as double)").alias("score_av"),
    )


def segment(ts: str, zone: str = "America/New_York") -> Column:
    """'rth' from 09:30 up to 16:00 local time, else 'ext'. ts is UTC."""
    local = F.from_utc_timestamp(ts, zone)
    minute = F.hour(local) * 60 + F.minute(local)
    return F.when((minute >= 570) & (minute < 960), "rth").otherwise("ext")
