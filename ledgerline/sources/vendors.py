"""Vendor payloads in canonical shape. Each function takes a frame as a vendor's reader gives it; fetching is a transport's task."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import first_wins
from ledgerline.operators.news import segment

PRICES = ["open", "high", "low", "close"]
#: Keys by which a daily-series vendor refuses a request.
REFUSALS = ["Error Message", "Information", "Note"]
_DAILY = "map<string,struct<`1. open`:string,`2. high`:string,`3. low`:string,`4. close`:string,`5. volume`:string>>"


def _number(c: str) -> Column:
    return F.col(c).try_cast("double")


def _whole(c: str) -> Column:
    """A volume: what is no number counts as none."""
    return F.coalesce(F.col(c).try_cast("double").cast("long"), F.lit(0).cast("long"))


def _priced(df: DataFrame) -> DataFrame:
    return df.where(" and ".join(f"{c} is not null and not isnan({c})" for c in PRICES))


def history_bars(hist: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Bars from (ticker, Date, Open, High, Low, Close, Volume): dates without zone, rows without a price dropped, a null volume 0."""
    out = hist.select(F.upper(ticker).alias("ticker"), F.to_date("Date").alias("date"), *(_number(c.title()).alias(c) for c in PRICES), _whole("Volume").alias("volume"))
    return _priced(out)


def history_actions(hist: DataFrame, ticker: str = "ticker") -> DataFrame:
    """(ticker, ex_date, action_type, value) from wide columns Dividends and `Stock Splits`; only values above 0."""
    wide = hist.select(F.upper(ticker).alias("ticker"), F.to_date("Date").alias("ex_date"), _number("Dividends").alias("dividend"), _number("`Stock Splits`").alias("split"))
    return wide.unpivot(["ticker", "ex_date"], ["dividend", "split"], "action_type", "value").where("value > 0 and not isnan(value)")


def refused(payload: str = "payload") -> Column:
    """The vendor's reason where a JSON payload is a refusal, else null."""
    return F.coalesce(*(F.get_json_object(payload, f"$['{k}']") for k in REFUSALS))


def _accepted(payloads: DataFrame) -> DataFrame:
    """Fails the query at a refused payload rather than give fewer rows."""
    why = refused()
    return payloads.withColumn("payload", F.when(why.isNotNull(), F.raise_error(F.concat(F.lit("request refused: "), why)).cast("string")).otherwise(F.col("payload")))


def daily_series(payloads: DataFrame, first, last) -> DataFrame:
    """Bars in [first, last] from (ticker, payload), the JSON of a daily series."""
    days = F.from_json(F.get_json_object("payload", "$['Time Series (Daily)']"), _DAILY)
    cell = lambda i, n: F.col("v").getField(f"{i}. {n}")
    out = _accepted(payloads).select(F.upper("ticker").alias("ticker"), F.explode(days).alias("d", "v"))
    out = out.select("ticker", F.to_date("d").alias("date"), *(cell(i + 1, n).cast("double").alias(n) for i, n in enumerate(PRICES)), cell(5, "volume").cast("long").alias("volume"))
    return out.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def action_series(payloads: DataFrame, first, last) -> DataFrame:
    """Actions in [first, last] from (ticker, payload), the JSON of a split or a dividend list (`data`)."""
    items = F.from_json(F.get_json_object("payload", "$.data"), "array<struct<effective_date:string,split_factor:string,ex_dividend_date:string,amount:string>>")
    rows = _accepted(payloads).select(F.upper("ticker").alias("ticker"), F.explode(items).alias("i"))
    is_split = F.col("i.effective_date").isNotNull()
    out = rows.select("ticker", F.to_date(F.coalesce("i.effective_date", "i.ex_dividend_date")).alias("ex_date"), F.when(is_split, "split").otherwise("dividend").alias("action_type"), F.coalesce("i.split_factor", "i.amount").cast("double").alias("value"))
    return out.where(F.col("ex_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def news_items(items: DataFrame) -> DataFrame:
    """Article rows from (ticker, content struct); items without url, title or a valid date go. Such items carry no relevance and no score."""
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    url = F.coalesce(text("content.canonicalUrl.url"), text("content.clickThroughUrl.url"))
    rows = items.select("*", url.alias("url")).where((F.col("url").isNotNull()) & text("content.title").isNotNull())
    none = F.lit(None).cast("double")
    out = rows.select(
        F.sha2("url", 256).alias("article_id"), F.col("content.pubDate").try_cast("timestamp").alias("published_at"), F.coalesce("content.provider.displayName", F.lit("")).alias("source"), F.col("content.title").alias("title"),
        F.coalesce(text("content.summary"), text("content.description"), F.lit("")).alias("summary"), "url", none.alias("overall_sentiment_score"), F.upper("ticker").alias("ticker"), none.alias("relevance"), none.alias("score_av"),
    )
    return out.where("published_at is not null")


def intraday_bars(rows: DataFrame) -> DataFrame:
    """(ticker, ts, open, high, low, close, volume, segment) from vendor minutes (ticker, timestamp in epoch seconds, ...): bars not yet closed (null volume) or without a price go, the first of equal instants stays."""
    out = rows.where("volume is not null").select(F.upper("ticker").alias("ticker"), F.timestamp_seconds("timestamp").alias("ts"), *(_number(c).alias(c) for c in PRICES), _whole("volume").alias("volume"))
    return first_wins(_priced(out), ["ticker", "ts"], "ts", [*PRICES, "volume"]).withColumn("segment", segment("ts"))


def _listed(schema: str) -> Column:
    """The payload's list as structs; what is no list counts as an empty one."""
    return F.explode(F.when(F.ltrim("payload").startswith("["), F.from_json("payload", f"array<struct<{schema}>>")))


def minute_payloads(payloads: DataFrame) -> DataFrame:
    """Intraday bars from (ticker, payload), each the JSON list of a ticker's minutes; payloads whose spans overlap give an instant once."""
    cells = ",".join(f"{c}:string" for c in [*PRICES, "volume"])
    return intraday_bars(payloads.select("ticker", _listed(f"timestamp:long,{cells}").alias("i")).select("ticker", "i.*").where("timestamp is not null"))


def bulk_payloads(payloads: DataFrame) -> DataFrame:
    """Daily bars from (payload), each the JSON list of an exchange's codes on one day; rows without a code or a date go."""
    cells = ",".join(f"{c}:string" for c in ["code", "date", *PRICES, "volume", "adjusted_close"])
    rows = payloads.select(_listed(cells).alias("i")).select("i.*")
    return bulk_bars(rows.withColumn("date", F.col("date").try_cast("date")).where("code <> '' and date is not null"))


def general_payloads(payloads: DataFrame, as_of) -> DataFrame:
    """Security-master rows from (ticker, exchange, payload), the JSON object of a company's general data; what is none counts as an object without fields."""
    general = F.from_json("payload", "Exchange string, GicSector string, GicGroup string, GicIndustry string, GicSubIndustry string")
    return sector_rows(payloads.select("ticker", "exchange", general.alias("general")), as_of)


def bulk_bars(rows: DataFrame, ticker: str = "code") -> DataFrame:
    """Daily bars from a bulk day or a symbol's history; an adjusted close is kept where the vendor gives one."""
    more = [_number("adjusted_close").alias("adjusted_close")] if "adjusted_close" in rows.columns else []
    return _priced(rows.select(F.upper(ticker).alias("ticker"), F.to_date("date").alias("date"), *(_number(c).alias(c) for c in PRICES), _whole("volume").alias("volume"), *more))


def sector_rows(general: DataFrame, as_of) -> DataFrame:
    """Security-master rows from (ticker, exchange, general struct): blank for what is missing, noted where all four levels are."""
    levels = {"gic_sector": "GicSector", "gic_group": "GicGroup", "gic_industry": "GicIndustry", "gic_sub_industry": "GicSubIndustry"}
    blank = lambda c: F.coalesce(c, F.lit(""))
    out = general.select(F.upper("ticker").alias("ticker"), blank(F.coalesce(F.nullif("exchange", F.lit("")), F.col("general.Exchange"))).alias("exchange"), *(blank(F.col(f"general.{v}")).alias(k) for k, v in levels.items()))
    return out.withColumns({
        "effective_from": F.lit(as_of).cast("date"), "effective_to": F.lit(None).cast("date"),
        "note": F.when(F.concat(*levels) == "", "gics_missing").otherwise(""),
    })


def coverage(rows: DataFrame, requested: int, errors: int = 0) -> DataFrame:
    """One row: requested, with_gics, missing, errors."""
    return rows.agg(F.lit(requested).alias("requested"), F.count_if(F.col("note") != "gics_missing").alias("with_gics"), F.count_if(F.col("note") == "gics_missing").alias("missing"), F.lit(errors).alias("errors"))


def payload_hash(df: DataFrame) -> str:
    """A digest of a payload's rows that doesn't depend on their order: count and sums of two hashes of each row."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    part = lambda seed: F.sum(F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(1 << 40)))
    return df.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)), part(1), part(2)), 256)).first()[0]


class RateLimiter:
    """Spaces calls of one process evenly."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep, self.lock, self.free = 60.0 / per_minute, clock, sleep, threading.Lock(), 0.0

    def acquire(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.free)
            self.free = start + self.gap
        if start > now:
            self.sleep(start - now)


def retried(call: Callable, transient: tuple[type[BaseException], ...] = (OSError, TimeoutError), tries: int = 4, sleep: Callable[[float], None] = time.sleep):
    """call(), tried again after 1, 2, 4, ... seconds (30 at most) on a transient error; the last error is raised."""
    for n in range(tries):
        try:
            return call()
        except transient:
            if n == tries - 1:
                raise
            sleep(min(2.0**n, 30.0))
