"""Vendors' transports as Python data sources. A request goes out from a task; what comes back is a row of text, which the functions in vendors.py work on.

A source takes its way to the network as `send`, a function (url) -> text, so that it can be replaced where there is no
network; the default one is urllib's. Requests are spaced per task and tried again on errors that pass.
"""

from __future__ import annotations

import json
import sys
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ledgerline.sources import vendors

#: Seconds after which a request is given up.
PATIENCE = 30.0
#: The vendors' addresses.
ADDRESSES = {
    "nasdaq_listed": "https://www.nasdaqtrader.com/dynamic/SymDir/nasdaqlisted.txt",
    "other_listed": "https://www.nasdaqtrader.com/dynamic/SymDir/otherlisted.txt",
    "daily": "https://www.alphavantage.co/query?function=TIME_SERIES_DAILY&outputsize=full&symbol={ticker}&apikey={key}",
    "splits": "https://www.alphavantage.co/query?function=SPLITS&symbol={ticker}&apikey={key}",
    "dividends": "https://www.alphavantage.co/query?function=DIVIDENDS&symbol={ticker}&apikey={key}",
    "history": "https://query1.finance.yahoo.com/v8/finance/chart/{ticker}?period1={first}&period2={last}&interval=1d&events=div%2Csplits",
    "minutes": "https://eodhd.com/api/intraday/{ticker}?interval=1m&from={first}&to={last}&fmt=json&api_token={key}",
    "bulk_day": "https://eodhd.com/api/eod-bulk-last-day/{ticker}?date={day}&fmt=json&api_token={key}",
    "general": "https://eodhd.com/api/fundamentals/{ticker}?filter=General&fmt=json&api_token={key}",
    "news": "https://query1.finance.yahoo.com/v1/finance/search?q={ticker}&newsCount={count}",
    "firehose": "https://www.alphavantage.co/query?function=NEWS_SENTIMENT&sort=EARLIEST&limit=1000&time_from={first}&time_to={last}&apikey={key}",
}
#: Longest window of one request for minutes.
MINUTES_DAYS = 120
#: Articles of a page of the firehose.
PAGE = 1000


def over_http(url: str) -> str:
    with urllib.request.urlopen(url, timeout=PATIENCE) as answer:  # noqa: S310
        return answer.read().decode("utf-8", "replace")


def _epoch(day: date) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp())


def spans(first: date, last: date, days: int = MINUTES_DAYS) -> list[tuple[date, date]]:
    """[first, last] in windows of at most so many days."""
    out = []
    while first <= last:
        to = min(last, first + timedelta(days - 1))
        out.append((first, to))
        first = to + timedelta(1)
    return out


class Requests(InputPartition):
    def __init__(self, rows: list[tuple[str, str]], per_minute: float):
        self.rows, self.per_minute = rows, per_minute


class RequestReader(DataSourceReader):
    """Rows (ticker, payload, error) of requests; a request that fails for good leaves its error and doesn't stop the others."""

    def __init__(self, options: dict[str, str], send: Callable[[str], str]):
        self.send, self.options = send, options
        self.per_minute, self.size = float(options.get("per_minute", "60")), int(options.get("batch", "200"))
        self.tasks, self.at_once = int(options.get("tasks", "4")), int(options.get("at_once", "4"))
        self.spans = json.loads(options.get("spans", "{}"))

    def urls(self) -> list[tuple[str, str]]:
        """(ticker, url) of all requests; the window's end is exclusive at the vendor, so a day is added."""
        o = self.options
        address = o.get("url") or ADDRESSES[o["what"]]
        tickers = [t.strip().upper() for t in o.get("tickers", "").split(",") if t.strip()] or [""]
        out = []
        for t in tickers:
            own = dict(zip(("start", "end"), self.spans.get(t, ()), strict=False))
            first, last = (date.fromisoformat(own.get(k, o.get(k))) if k in own or k in o else None for k in ("start", "end"))
            windows = spans(first, last) if o.get("what") == "minutes" else [(first, last)]
            for a, b in windows:
                named = {"ticker": urllib.parse.quote(t), "key": o.get("key", ""), "count": o.get("count", "50"), "first": _epoch(a) if a else "", "last": _epoch(b + timedelta(1)) if b else "", "day": b or ""}
                out.append((t, address.format(**named)))
        return out

    def partitions(self) -> list[Requests]:
        """Requests by chunks, in at most `tasks` partitions that share the vendor's rate, so that all tasks together stay within it."""
        every = self.urls()
        n = max(1, min(self.tasks, -(-len(every) // self.size)))
        return [Requests(every[i::n], self.per_minute / n) for i in range(n)]

    def read(self, partition: Requests) -> Iterator[tuple]:
        """Requests start at the partition's rate; up to at_once of them wait for their answers at a time."""
        gate = vendors.RateLimiter(partition.per_minute)

        def one(ticker: str, url: str) -> tuple:
            def call() -> str:
                gate.acquire()  # a request that is tried again counts again
                return self.send(url)

            try:
                return ticker, vendors.retried(call), None
            except (OSError, ValueError) as e:
                return ticker, None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(self.at_once) as pool:
            for at in range(0, len(partition.rows), self.size):  # answers of one chunk are held
                yield from pool.map(lambda r: one(*r), partition.rows[at : at + self.size])


class VendorRequests(DataSource):
    """spark.read.format("vendor_requests").options(what="daily", tickers="A,B", start="2024-01-02", end="2024-02-01", key="...").load()"""

    send: Callable[[str], str] = staticmethod(over_http)

    @classmethod
    def name(cls) -> str:
        return "vendor_requests"

    def schema(self) -> str:
        return "ticker string, payload string, error string"

    def reader(self, schema) -> RequestReader:
        return RequestReader(dict(self.options), type(self).send)


class Day(InputPartition):
    def __init__(self, day: str):
        self.day = day


class NewsReader(DataSourceStreamReader):
    """A news stream whose offsets are days: each batch is the next day, up to `last`. A task pages through it and gives its articles, then a row without one, which says that the day was read whole; a day that fails, or has more pages than allowed, fails its batch."""

    def __init__(self, options: dict[str, str], send: Callable[[str], str]):
        self.send, self.options = send, options
        self.reached, self.last = options["after"], options["last"]

    def initialOffset(self) -> dict:
        return {"day": self.options["after"]}

    def latestOffset(self) -> dict:
        # what was asked for is given in order, a day at a time: self.reached is the last day that was planned
        return {"day": str(min(date.fromisoformat(self.reached) + timedelta(1), max(date.fromisoformat(self.last), date.fromisoformat(self.reached))))}

    def partitions(self, start: dict, end: dict) -> list[Day]:
        self.reached = max(self.reached, end["day"])
        first, last = date.fromisoformat(start["day"]), date.fromisoformat(end["day"])
        return [Day(str(first + timedelta(i))) for i in range(1, (last - first).days + 1)]

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: Day) -> Iterator[tuple]:
        day, pages = date.fromisoformat(partition.day), int(self.options.get("pages", "25"))
        gate = vendors.RateLimiter(float(self.options.get("per_minute", "60")))

        def send(url: str) -> str:
            gate.acquire()
            return self.send(url)

        items, whole = paged_day(day, send, self.options.get("key", ""), pages)
        if not whole:
            raise ValueError(f"more pages than allowed on {day}")
        for item in items:
            yield day, json.dumps(item)
        yield day, None


class VendorNews(DataSource):
    """spark.readStream.format("vendor_news").options(after="2024-01-01", last="2024-01-31", key="...").load(): the days after `after`."""

    send: Callable[[str], str] = staticmethod(over_http)

    @classmethod
    def name(cls) -> str:
        return "vendor_news"

    def schema(self) -> str:
        return "day date, item string"

    def streamReader(self, schema) -> NewsReader:
        return NewsReader(dict(self.options), type(self).send)


def register(spark: SparkSession, send: Callable[[str], str] | None = None) -> None:
    """Makes the sources known; send: another way to the network."""
    for module in (sys.modules[__name__], sys.modules[vendors.__name__]):
        cloudpickle.register_pickle_by_value(module)  # workers need not have this package installed
    for source in (VendorRequests, VendorNews):
        spark.dataSource.register(type(source.__name__, (source,), {"send": staticmethod(send or over_http)}))


def requested(spark: SparkSession, what: str, tickers: list[str], **options) -> DataFrame:
    """(ticker, payload, error). The requests' plan is as long as the list of tickers, which a universe bounds."""
    return spark.read.format("vendor_requests").options(what=what, tickers=",".join(tickers), **{k: str(v) for k, v in options.items()}).load()


def directory(spark: SparkSession, what: str) -> DataFrame:
    """Lines (value) of a listing directory, for files.listing."""
    got = requested(spark, what, [])
    text = F.coalesce("payload", F.raise_error(F.concat(F.lit("directory not fetched: "), "error")).cast("string"))
    return got.select(F.explode(F.split(text, "\r?\n")).alias("value"))


_CHART = "struct<chart:struct<result:array<struct<timestamp:array<bigint>,events:struct<dividends:map<string,struct<amount:double,date:bigint>>,splits:map<string,struct<numerator:double,denominator:double,date:bigint>>>,indicators:struct<quote:array<struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>>>>>>>>"


def chart_history(payloads: DataFrame) -> DataFrame:
    """(ticker, Date, Open, High, Low, Close, Volume, Dividends, `Stock Splits`) from chart payloads, in the shape that vendors.history_bars and history_actions take. Days of events without a bar come with null prices."""
    chart = payloads.where("payload is not null").select("ticker", F.from_json("payload", _CHART)["chart"]["result"].alias("r")).select("ticker", F.inline("r"))
    day = lambda c: F.to_date(F.timestamp_seconds(c))
    quote = F.get("indicators.quote", F.lit(0))
    bars = chart.select("ticker", F.explode(F.arrays_zip(F.col("timestamp").alias("t"), *(quote[c].alias(c) for c in ("open", "high", "low", "close", "volume")))).alias("b"))
    bars = bars.select("ticker", day("b.t").alias("Date"), *(F.col(f"b.{c}").alias(c.title()) for c in ("open", "high", "low", "close", "volume")))
    cash = chart.select("ticker", F.explode(F.map_values("events.dividends")).alias("e")).select("ticker", day("e.date").alias("Date"), F.col("e.amount").alias("Dividends"), F.lit(None).cast("double").alias("Stock Splits"))
    split = chart.select("ticker", F.explode(F.map_values("events.splits")).alias("e")).select("ticker", day("e.date").alias("Date"), F.lit(None).cast("double").alias("Dividends"), F.try_divide("e.numerator", "e.denominator").alias("Stock Splits"))
    events = cash.unionByName(split).groupBy("ticker", "Date").agg(F.max("Dividends").alias("Dividends"), F.max("Stock Splits").alias("Stock Splits"))
    return bars.join(events, ["ticker", "Date"], "full")


def history(spark: SparkSession, plan: DataFrame, dataset: str) -> DataFrame:
    """Bars or actions for a plan (ticker, start, end) of one batch, with status and error; one request a ticker over its own span."""
    asked = plan.groupBy(F.upper("ticker").alias("ticker")).agg(F.min("start").alias("start"), F.max("end").alias("end")).collect()  # a batch's tickers
    got = requested(spark, "history", [r.ticker for r in asked], spans=json.dumps({r.ticker: (str(r.start), str(r.end)) for r in asked}))
    wide = chart_history(got)
    rows = vendors.history_bars(wide) if dataset == "ohlcv_daily" else vendors.history_actions(wide)
    failed = got.where("payload is null").select("ticker", F.lit("failed").alias("status"), "error")
    return rows.withColumn("status", F.lit("ok")).unionByName(failed, allowMissingColumns=True)


def harvested(payloads: DataFrame) -> DataFrame:
    """Article rows from a ticker's news payloads; a request that failed gives none."""
    content = "struct<canonicalUrl:struct<url:string>,clickThroughUrl:struct<url:string>,pubDate:string,provider:struct<displayName:string>,title:string,summary:string,description:string>"
    items = payloads.where("payload is not null").select("ticker", F.explode(F.from_json("payload", f"struct<news:array<struct<content:{content}>>>")["news"]).alias("i"))
    return vendors.news_items(items.select("ticker", F.col("i.content").alias("content")))


def paged_day(day: date, send: Callable[[str], str], key: str = "", pages: int = 25) -> tuple[list[dict], bool]:
    """(articles, whether all pages were read) of a UTC day: each page begins a minute after the last article of the one before, and a page that isn't full is the last."""
    first, last = datetime(day.year, day.month, day.day), datetime(day.year, day.month, day.day, 23, 59)
    found: list[dict] = []
    for _ in range(pages):
        url = ADDRESSES["firehose"].format(first=first.strftime("%Y%m%dT%H%M"), last=last.strftime("%Y%m%dT%H%M"), key=key)
        answer = json.loads(vendors.retried(lambda u=url: send(u)))
        if why := next((answer[k] for k in vendors.REFUSALS if k in answer), None):
            raise ValueError(f"request refused: {why}")
        items = answer.get("feed", [])
        found += items
        if len(items) < PAGE:
            return found, True
        first = datetime.strptime(items[-1]["time_published"], "%Y%m%dT%H%M%S").replace(second=0) + timedelta(minutes=1)
        if first > last:
            return found, True
    return found, False
