"""Queries of the jobs, stores and vendors' payloads, with the same in DuckDB's SQL. Lakes that a query fills lie in the shared folder for the session's length."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.operators import dedupe, ingest, news, research, tables
from ledgerline.plans import gate
from ledgerline.plans.catalog import _query, _r
from ledgerline.plans.jobs import Lake, canonical_actions, canonical_bars
from ledgerline.sources import files, store, synthetic, transports, vendors
from ledgerline.streaming.promote import promote

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 2, 1)


def _scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share; the session's end removes it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-")
    path = f"{base.rstrip('/')}/lake-{uuid.uuid4().hex}"

    def remove() -> None:
        if spark.sparkContext._jvm is not None and spark.sparkContext._jsc is not None:  # else the session ended first
            fs, where = store._fs(spark, path)
            fs.delete(where, True)

    atexit.register(remove)
    return path


def _lake(spark: SparkSession, sessions: DataFrame | None = None) -> Lake:
    return Lake(spark, _scratch(spark), spark.createDataFrame([], "calendar string, session date") if sessions is None else sessions)


def _priced(bars: DataFrame) -> DataFrame:
    """Bars with prices that differ."""
    return bars.select("ticker", "date", F.col("close").alias("open"), (F.col("close") + 2).alias("high"), (F.col("close") - 1).alias("low"), "close", "volume")


@_query("SELECT ticker, date, CASE WHEN volume % 2 = 0 THEN close ELSE close + 1 END AS close, volume FROM bars", ("bars",))
def latest_capture(bars):
    lake = _lake(bars.sparkSession)
    for when, rows in ((EARLY, bars.withColumn("close", F.col("close") + 1)), (LATE, bars.where("volume % 2 = 0"))):
        store.write_raw(_priced(rows).withColumns({"ticker": F.lower("ticker"), "ingested_at": F.lit(when)}), lake.root, "p", "ohlcv_daily", uuid.uuid4().hex)
    return lake.latest_raw("p", "ohlcv_daily").select("ticker", "date", "close", "volume")


@_query("SELECT ticker, date, CASE WHEN volume % 3 = 0 THEN close + 1 ELSE close END AS close, volume, CAST(year(date) AS INT) AS year FROM bars UNION ALL SELECT concat(ticker, 'X'), date, close, volume, CAST(year(date) AS INT) FROM bars WHERE volume % 5 = 0 AND year(date) = 1995", ("bars",))
def table_upsert(bars):
    path, rows = f"{_scratch(bars.sparkSession)}/t", bars.withColumn("year", F.year("date"))
    store.upsert(rows, path, ["ticker", "date"], "year")
    changed = rows.where("volume % 3 = 0").withColumn("close", F.col("close") + 1)
    store.upsert(changed.unionByName(rows.where("volume % 5 = 0 and year = 1995").withColumn("ticker", F.concat("ticker", F.lit("X")))), path, ["ticker", "date"], "year")
    return store.read_table(bars.sparkSession, path)


@_query("SELECT ticker, date, CASE WHEN volume % 3 = 0 THEN close + 1 ELSE close END AS close, volume FROM bars", ("bars",))
def first_capture(bars):
    path = f"{_scratch(bars.sparkSession)}/t"
    store.upsert(bars.where("volume % 3 = 0").withColumn("close", F.col("close") + 1), path, ["ticker", "date"], first=True)
    store.upsert(bars, path, ["ticker", "date"], first=True)
    return store.read_table(bars.sparkSession, path)


@_query("SELECT ticker, date, CASE WHEN volume % 4 = 0 THEN close + 5 ELSE close END AS close, volume, CAST(year(date) AS INT) AS year FROM bars", ("bars",))
def promoted_files(bars):
    spark, root = bars.sparkSession, _scratch(bars.sparkSession)
    rows = bars.withColumn("year", F.year("date"))
    for n, part in enumerate((rows, rows.where("volume % 4 = 0").withColumn("close", F.col("close") + 5))):
        part.coalesce(2).write.parquet(f"{root}/raw/{n}")
        for _ in range(2):  # a file that was taken isn't taken again
            promote(spark, f"{root}/raw", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), f"{root}/t", f"{root}/c", ["ticker", "date"], partition="year")
    return store.read_table(spark, f"{root}/t")


@_query("SELECT b.ticker, b.date, b.close FROM bars b JOIN (SELECT ticker, CAST(min(date) + 700 AS DATE) AS s FROM bars GROUP BY 1) p USING (ticker) WHERE b.date >= p.s", ("bars",))
def payload_trim(bars):
    plan = bars.groupBy("ticker").agg(F.date_add(F.min("date"), 700).alias("start"))
    return ingest.trimmed(bars.select("ticker", "date", "close"), plan)


@_query("""WITH h AS (SELECT provider, CASE WHEN seq % 4 < 2 THEN 'corporate_actions' ELSE 'ohlcv_daily' END AS dataset, ticker, CASE WHEN seq % 4 < 2 THEN greatest(started_at, DATE '1997-01-01') ELSE started_at END AS high FROM manifest WHERE status = 'ok')
SELECT provider, dataset, ticker, max(high) AS high_water_date FROM h GROUP BY 1, 2, 3""", ("manifest",))
def high_waters(manifest):
    fetched = manifest.withColumns({"dataset": F.when(F.col("seq") % 4 < 2, "corporate_actions").otherwise("ohlcv_daily"), "last_date": F.col("started_at"), "end": F.lit(date(1997, 1, 1))})
    return ingest.high_waters(fetched)


@_query("""WITH p AS (SELECT DISTINCT provider, dataset, ticker, CASE WHEN length(ticker) % 2 = 0 THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS start FROM manifest)
SELECT provider, dataset, ticker, start, concat(provider, ':', dataset, '@', CAST(start AS VARCHAR)) AS signature FROM p""", ("manifest",))
def fetch_batches(manifest):
    plan = manifest.select("provider", "dataset", "ticker").distinct().withColumn("start", F.when(F.length("ticker") % 2 == 0, F.lit(date(2024, 1, 2))).otherwise(F.lit(date(2024, 1, 3))))
    return ingest.batches(plan, 50).select("provider", "dataset", "ticker", "start", F.substring_index("batch", ":", 2).alias("signature"))


@_query("SELECT ticker, max(date) AS date, max_by(score, date) AS score, max_by(n_articles, date) AS n_articles FROM factor GROUP BY ticker", ("factor",))
def latest_sentiment(factor):
    return research.latest(factor, "ticker", "date", ["score", "n_articles"])


@_query("SELECT count(DISTINCT date) AS n_dates, count(DISTINCT ticker) AS n_tickers FROM factor WHERE score > 0.5", ("factor",))
def sample_sizes(factor):
    return research.sample_sizes(factor.where("score > 0.5"))


@_query("SELECT ticker, date, close FROM bars WHERE date BETWEEN DATE '1994-02-01' AND DATE '1996-05-31' AND ticker IN ('S1', 'S2', 'S5')", ("bars",))
def bounded_closes(bars):
    return research.bounded(bars.select("ticker", "date", "close"), "1994-02-01", "1996-05-31", ["S1", "S2", "S5"])


@_query("SELECT * FROM factor WHERE ticker IN ('S3', 'S4') AND date >= DATE '1995-01-01'", ("factor",))
def basket_sentiment(factor):
    return research.bounded(factor, "1995-01-01", tickers=["S3", "S4"])


@_query("SELECT upper(ticker) AS ticker, date, CASE WHEN volume % 6 = 0 THEN NULL ELSE close END AS open, close + 2 AS high, close - 1 AS low, close, CASE WHEN volume % 7 = 0 THEN NULL ELSE volume END AS volume FROM bars", ("bars",))
def canonical_shape(bars):
    raw = _priced(bars).withColumns({"ticker": F.concat(F.lit(" "), F.lower("ticker"), F.lit(" ")), "date": F.col("date").cast("timestamp"), "open": F.when(F.col("volume") % 6 == 0, "n/a").otherwise(F.col("open").cast("string")), "volume": F.when(F.col("volume") % 7 == 0, "-").otherwise(F.col("volume").cast("string"))})
    return canonical_bars(raw)


@_query("SELECT ticker, ex_date, action_type, CASE WHEN value > 3 THEN NULL ELSE value END AS value FROM actions", ("actions",))
def canonical_events(actions):
    return canonical_actions(actions.withColumns({"ticker": F.lower("ticker"), "action_type": F.upper("action_type"), "ex_date": F.col("ex_date").cast("string"), "value": F.when(F.col("value") > 3, "three").otherwise(F.col("value").cast("string"))}))


@_query("""WITH b AS (SELECT ticker, ex_date, CASE WHEN value > 4.5 THEN 'rights' ELSE action_type END AS t, CASE WHEN value > 4 THEN NULL WHEN value < 0.5 THEN -value ELSE value END AS value FROM actions), k AS (SELECT *, count(*) OVER (PARTITION BY ticker, ex_date, t) AS n FROM b)
SELECT c AS "check", count(*) AS n FROM (SELECT unnest([CASE WHEN value IS NULL THEN 'not_null_value' END, CASE WHEN t NOT IN ('split', 'dividend') THEN 'action_known' END, CASE WHEN value <= 0 THEN 'value_positive' END, CASE WHEN n > 1 THEN 'unique_key' END]) AS c FROM k) WHERE c IS NOT NULL GROUP BY 1""", ("actions",))
def action_checks(actions):
    bad = actions.withColumns({"action_type": F.when(F.col("value") > 4.5, "rights").otherwise(F.col("action_type")), "value": F.when(F.col("value") <= 4, F.when(F.col("value") < 0.5, -F.col("value")).otherwise(F.col("value")))})
    key = ["ticker", "ex_date", "action_type"]
    return tables.split_valid(tables.validated(bad, tables.ACTIONS, key, ["value"]))[1].groupBy("check").agg(F.count("*").alias("n"))


@_query("""WITH a AS (SELECT CASE WHEN page_id % 5 = 0 THEN 'x' ELSE sha256(url) END AS id, CASE WHEN page_id % 3 = 0 THEN 1.5 WHEN page_id % 4 = 0 THEN NULL ELSE -0.5 END AS s FROM pages), k AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM a)
SELECT c AS "check", count(*) AS n FROM (SELECT unnest([CASE WHEN id IS NULL THEN 'not_null_article_id' END, CASE WHEN NOT regexp_full_match(id, '[0-9a-f]{64}') THEN 'article_id_hex' END, CASE WHEN abs(s) > 1 THEN 'overall_in_range' END, CASE WHEN n > 1 THEN 'unique_key' END]) AS c FROM k) WHERE c IS NOT NULL GROUP BY 1""")
def article_checks(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = pages.select(F.when(F.col("page_id") % 5 == 0, "x").otherwise(F.sha2("url", 256)).alias("article_id"), F.when(F.col("page_id") % 3 == 0, 1.5).when(F.col("page_id") % 4 == 0, None).otherwise(-0.5).alias("overall_sentiment_score"))
    return tables.split_valid(tables.validated(rows, tables.ARTICLES, ["article_id"], ["article_id"]))[1].groupBy("check").agg(F.count("*").alias("n"))


@_query("""WITH a AS (SELECT article_id, CASE WHEN length(article_id) % 5 = 0 THEN '' ELSE ticker END AS ticker, relevance * 1.2 AS relevance, score_av * 1.1 AS score_av FROM news)
SELECT c AS "check", count(*) AS n FROM (SELECT unnest([CASE WHEN length(ticker) NOT BETWEEN 1 AND 12 THEN 'ticker_length' END, CASE WHEN relevance NOT BETWEEN 0 AND 1 THEN 'relevance_in_range' END, CASE WHEN abs(score_av) > 1 THEN 'score_in_range' END]) AS c FROM a) WHERE c IS NOT NULL GROUP BY 1""", ("news",))
def sentiment_checks(news_):
    rows = news_.withColumns({"ticker": F.when(F.length("article_id") % 5 == 0, "").otherwise(F.col("ticker")), "relevance": F.col("relevance") * 1.2, "score_av": F.col("score_av") * 1.1})
    return tables.split_valid(tables.validated(rows, tables.TICKER_SENTIMENT, ["article_id"], ["article_id"]))[1].groupBy("check").agg(F.count("*").alias("n"))


_FEED = """f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '' ELSE concat('http://x/', CAST(o_orderkey AS VARCHAR)) END AS url, o_orderkey % 17 = 0 AS untimed, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS n FROM orders)"""


@_query(f"""WITH {_FEED}, t AS (SELECT *, unnest(CASE WHEN n = 0 THEN [NULL] WHEN n = 1 THEN ['AA'] ELSE ['AA', 'B.HK'] END) AS ticker FROM f WHERE url IS NOT NULL AND url <> '' AND NOT untimed)
SELECT sha256(url) AS article_id, strftime(d, '%Y-%m-%d 10:20:30') AS published_at, 'v' AS provider, CAST(k AS VARCHAR) AS title, ticker, CASE WHEN ticker = 'AA' THEN 0.5::DOUBLE END AS relevance, CASE WHEN ticker IS NOT NULL THEN CAST(k % 7 AS DOUBLE) / 10 END AS score_av FROM t""")
def feed_articles(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey")
    one = lambda t, r: F.struct(F.lit(t).alias("ticker"), F.lit(r).alias("relevance_score"), ((k % 7).cast("double") / 10).cast("string").alias("ticker_sentiment_score"))
    some = F.when(k % 5 == 0, None).when(k % 5 == 1, F.array(one("aa", "0.5"))).otherwise(F.array(one("aa", "0.5"), one("b.hk", "none")))
    stamp = F.when(k % 17 == 0, "later").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T102030")))
    feed = o.select(k.cast("string").alias("title"), F.when(k % 13 == 0, None).when(k % 29 == 0, "").otherwise(F.concat(F.lit("http://x/"), k.cast("string"))).alias("url"), stamp.alias("time_published"), F.lit("s").alias("source"), F.lit("").alias("summary"), F.lit(0.1).alias("overall_sentiment_score"), some.alias("ticker_sentiment"))
    return news.parse_feed(feed, "v").select("article_id", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "provider", "title", "ticker", "relevance", "score_av")


@_query("SELECT sha256(url) AS article_id, 'T' AS ticker, CAST(page_id AS VARCHAR) AS title, CASE WHEN page_id % 2 = 0 THEN 'long' ELSE '' END AS summary, CASE WHEN page_id % 3 = 0 THEN 'P' ELSE '' END AS source FROM pages WHERE url IS NOT NULL AND url <> '' AND page_id % 7 <> 0 AND page_id % 11 <> 0")
def vendor_articles(spark, sf_dir):
    k = F.col("page_id")
    content = F.struct(
        F.struct(F.when(k % 2 == 0, F.col("url")).alias("url")).alias("canonicalUrl"), F.struct(F.col("url")).alias("clickThroughUrl"), F.when(k % 11 == 0, "soon").otherwise("2024-01-02T03:04:05Z").alias("pubDate"),
        F.struct(F.when(k % 3 == 0, "P").alias("displayName")).alias("provider"), F.when(k % 7 != 0, k.cast("string")).alias("title"), F.lit("").alias("summary"), F.when(k % 2 == 0, "long").alias("description"),
    )
    items = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.lit("t").alias("ticker"), content.alias("content"))
    return vendors.news_items(items).select("article_id", "ticker", "title", "summary", "source")


@_query("SELECT ticker, date, close AS open, close + 2 AS high, close - 1 AS low, close, volume FROM bars WHERE date BETWEEN DATE '1994-01-01' AND DATE '1995-12-31'", ("bars",))
def daily_payloads(bars):
    day = F.struct(*(F.col(c).cast("string").alias(f"{i}. {c}") for i, c in enumerate([*vendors.PRICES, "volume"], 1)))
    series = _priced(bars).groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct(F.col("date").cast("string"), day))).alias("Time Series (Daily)"))
    return vendors.daily_series(series.select(F.lower("ticker").alias("ticker"), F.to_json(F.struct("Time Series (Daily)")).alias("payload")), "1994-01-01", "1995-12-31")


@_query("SELECT ticker, ex_date, action_type, value FROM actions WHERE ex_date BETWEEN DATE '1993-01-01' AND DATE '1996-12-31'", ("actions",))
def action_payloads(actions):
    item = F.when(F.col("action_type") == "split", F.struct(F.col("ex_date").cast("string").alias("effective_date"), F.col("value").cast("string").alias("split_factor"), F.lit(None).cast("string").alias("ex_dividend_date"), F.lit(None).cast("string").alias("amount")))
    item = item.otherwise(F.struct(F.lit(None).cast("string").alias("effective_date"), F.lit(None).cast("string").alias("split_factor"), F.col("ex_date").cast("string").alias("ex_dividend_date"), F.col("value").cast("string").alias("amount")))
    lists = actions.groupBy("ticker", "action_type").agg(F.collect_list(item).alias("data"))
    return vendors.action_series(lists.select("ticker", F.to_json(F.struct("data")).alias("payload")), "1993-01-01", "1996-12-31")


_GICS = "g AS (SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS ticker, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS exchange, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS gic_sector, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE 'G' END AS gic_group FROM customer)"


def _general(spark, sf_dir):
    k = F.col("c_custkey")
    general = F.struct(F.lit("XX").alias("Exchange"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("GicSector"), F.when(k % 8 != 0, "G").alias("GicGroup"), F.lit(None).cast("string").alias("GicIndustry"), F.lit(None).cast("string").alias("GicSubIndustry"))
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("c"), k.cast("string")).alias("ticker"), F.when(k % 3 == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("exchange"), general.alias("general"))
    return vendors.sector_rows(rows, "2024-01-01")


@_query(f"WITH {_GICS} SELECT ticker, CASE WHEN exchange = '' THEN 'XX' ELSE exchange END AS exchange, gic_sector, gic_group, '' AS gic_industry, '' AS gic_sub_industry, CASE WHEN gic_sector = '' AND gic_group = '' THEN 'gics_missing' ELSE '' END AS note FROM g")
def sector_rows(spark, sf_dir):
    return _general(spark, sf_dir).drop("effective_from", "effective_to")


@_query(f"WITH {_GICS} SELECT CAST(500 AS INT) AS requested, count(*) FILTER (WHERE gic_sector <> '' OR gic_group <> '') AS with_gics, count(*) FILTER (WHERE gic_sector = '' AND gic_group = '') AS missing, CAST(3 AS INT) AS errors FROM g")
def sector_coverage(spark, sf_dir):
    return vendors.coverage(_general(spark, sf_dir), 500, 3)


@_query(f"WITH {_GICS} SELECT ticker, CASE WHEN exchange = '' THEN 'XX' ELSE exchange END AS exchange, gic_sector, gic_group, '' AS gic_industry, '' AS gic_sub_industry, CASE WHEN gic_sector = '' AND gic_group = '' THEN 'gics_missing' ELSE '' END AS note FROM g")
def general_payloads(spark, sf_dir):
    k = F.col("c_custkey")
    fields = F.struct(F.lit("XX").alias("Exchange"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("GicSector"), F.when(k % 8 != 0, "G").alias("GicGroup"), F.lit(1).alias("Employees"))
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("c"), k.cast("string")).alias("ticker"), F.when(k % 3 == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("exchange"), F.to_json(fields).alias("payload"))
    return vendors.general_payloads(rows, "2024-01-01").drop("effective_from", "effective_to")


@_query("""WITH e AS (SELECT upper(event_type) AS ticker, to_timestamp(floor(epoch(ts) / 60) * 60)::TIMESTAMP AS t, CAST(event_id % 500 AS DOUBLE) AS p, CAST(event_id % 90 AS BIGINT) AS v FROM events WHERE event_id % 7 <> 0),
m AS (SELECT ticker, t, min((p, v)) AS x FROM e GROUP BY 1, 2)
SELECT ticker, CAST(epoch(t) AS BIGINT) AS at, x[1] AS open, x[1] AS high, x[1] AS low, x[1] AS close, x[2] AS volume FROM m""")
def minute_payloads(spark, sf_dir):
    stamp = F.unix_timestamp(F.col("ts").cast("timestamp"))
    item = F.struct((F.floor(stamp / 60) * 60).alias("timestamp"), *((F.col("event_id") % 500).cast("double").alias(c) for c in vendors.PRICES), F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 90).alias("volume"))
    # a payload for each ticker and hour; every other hour's minutes come twice
    hours = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.lower("event_type").alias("ticker"), F.floor(stamp / 3600).alias("hour")).agg(F.to_json(F.collect_list(item), {"ignoreNullFields": "false"}).alias("payload"))
    again = hours.where("hour % 2 = 0").unionByName(hours).unionByName(hours.withColumn("payload", F.lit('{"message": "nothing"}')))
    return vendors.minute_payloads(again.drop("hour")).select("ticker", F.unix_timestamp("ts").alias("at"), *vendors.PRICES, "volume")


@_query("SELECT concat('V', CAST(l_suppkey AS VARCHAR)) AS ticker, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS open, l_extendedprice AS high, l_extendedprice AS low, l_extendedprice AS close, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS volume, CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice END AS adjusted_close FROM lineitem WHERE l_linenumber % 3 <> 0")
def bulk_payloads(spark, sf_dir):
    odd, price = F.col("l_linenumber") % 2 != 0, F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice").cast("double"))
    item = F.struct(F.concat(F.lit("v"), F.col("l_suppkey").cast("string")).alias("code"), F.to_date("l_shipdate").cast("string").alias("date"), *(price.alias(c) for c in vendors.PRICES), F.when(odd, F.col("l_quantity").cast("double")).alias("volume"), F.when(odd, price).alias("adjusted_close"))
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_shipdate", F.pmod(F.hash("l_orderkey"), F.lit(8)).alias("part")).agg(F.to_json(F.collect_list(item)).alias("payload"))
    return vendors.bulk_payloads(days)


@_query("SELECT article_id, CASE WHEN length(article_id) % 2 = 0 THEN CAST(date + 9 AS VARCHAR) ELSE CAST(date AS VARCHAR) END AS day FROM news", ("news",))
def late_articles(news_):
    rows = news_.withColumns({"published_at": F.col("date").cast("timestamp"), "ingested_at": F.when(F.length("article_id") % 2 == 0, F.date_add("date", 9)).otherwise(F.date_sub("date", 2)).cast("timestamp")})
    return news.effective(rows).select("article_id", F.to_date("effective_ts").cast("string").alias("day"))


@_query("SELECT sha256(article_id) AS article_id, ticker, relevance, score_av FROM news WHERE length(ticker) BETWEEN 1 AND 12", ("news",))
def curated_news(news_):
    lake = _lake(news_.sparkSession)
    rows = news_.select(F.sha2("article_id", 256).alias("article_id"), F.col("date").cast("timestamp").alias("published_at"), F.lit(EARLY).alias("ingested_at"), F.lit("s").alias("source"), F.lit("p").alias("provider"), F.lit("t").alias("title"), F.lit("").alias("summary"), F.col("article_id").alias("url"), F.lit(0.0).alias("overall_sentiment_score"), "ticker", "relevance", "score_av")
    lake.curate_news(rows.unionByName(rows.withColumns({"ingested_at": F.lit(LATE), "score_av": F.lit(0.9)})))
    lake.curate_news(rows.withColumns({"ingested_at": F.lit(EARLY), "score_av": F.lit(-0.9)}))
    return lake.table("news_ticker_sentiment").select("article_id", "ticker", "relevance", "score_av")


@_query("""WITH a AS (SELECT article_id, ticker, coalesce(relevance, 1.0) AS w, score_av, CASE WHEN date IN (SELECT session FROM sessions) THEN date ELSE (SELECT min(session) FROM sessions WHERE session > date) END AS day FROM news WHERE date >= (SELECT min(session) FROM sessions) AND date < (SELECT max(session) FROM sessions))
SELECT ticker, day AS date, round(sum(score_av * w) / sum(CASE WHEN score_av IS NOT NULL THEN w END), 8) + 0.0::DOUBLE AS sent_av, count(DISTINCT article_id) AS n_articles, round(sum(w), 8) + 0.0::DOUBLE AS rel_sum FROM a WHERE w >= 0.25 AND day IS NOT NULL GROUP BY 1, 2""", ("news", "sessions"))
def built_factor(news_, sessions):
    lake = _lake(news_.sparkSession)
    span = sessions.agg(F.min("session").alias("lo"), F.max("session").alias("hi"))
    rows = news_.join(F.broadcast(span)).where("date >= lo and date < hi")
    instant = F.timestamp_seconds(F.unix_date("date") * 86400 + 15 * 3600)
    lake._put("news_ticker_sentiment", rows.select("article_id", "ticker", instant.alias("published_at"), instant.alias("ingested_at"), "relevance", "score_av"))
    lake.build_sentiment(calendar.calendar_map(sessions.withColumn("calendar", F.lit("XNYS"))))
    return _r(lake.table("sentiment_daily").select("ticker", "date", "sent_av", "n_articles", "rel_sum"), 8, "sent_av", "rel_sum")


@_query("SELECT index_name, ticker, effective_from, CASE WHEN effective_to IS NULL AND ticker NOT IN (SELECT ticker FROM snapshot) THEN DATE '2024-01-01' ELSE effective_to END AS effective_to FROM membership UNION ALL SELECT 'IDX', ticker, DATE '2024-01-01', NULL FROM snapshot WHERE ticker NOT IN (SELECT ticker FROM membership WHERE effective_to IS NULL)", ("membership", "snapshot"))
def roster_refresh(membership, snapshot):
    lake = _lake(membership.sparkSession)
    lake._put("universe_membership", membership)
    lake.refresh_roster(snapshot.select(F.lit("IDX").alias("index_name"), "ticker"), "2024-01-01", "directory")
    return lake.table("universe_membership").select("index_name", "ticker", "effective_from", "effective_to")


@_query("""WITH j AS (SELECT m.*, s.sector AS ns, s.exchange AS ne, s.ticker IS NOT NULL AS seen FROM (SELECT * FROM master WHERE effective_to IS NULL) m LEFT JOIN snapshot s USING (ticker)), c AS (SELECT *, seen AND (sector <> ns OR exchange <> ne) AS changed FROM j)
SELECT ticker, exchange, sector AS gic_sector, effective_from, CASE WHEN changed THEN DATE '2024-01-01' END AS effective_to FROM c
UNION ALL SELECT ticker, exchange, sector, DATE '2024-01-01', NULL FROM snapshot s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.ticker = s.ticker AND NOT c.changed)""", ("master", "snapshot"))
def master_refresh(master, snapshot):
    lake = _lake(master.sparkSession)
    shaped = lambda df: df.select("ticker", "exchange", F.col("sector").alias("gic_sector"), *(F.lit("").alias(c) for c in ("gic_group", "gic_industry", "gic_sub_industry")))
    lake.refresh_master(shaped(master.where("effective_to is null")), "2020-01-01")
    lake.refresh_master(shaped(snapshot), "2024-01-01")
    return lake.table("security_master").select("ticker", "exchange", "gic_sector", "effective_from", "effective_to")


@_query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY substr(p_name, 1, 4) ORDER BY p_partkey) AS rn FROM part) SELECT upper(trim(substr(p_name, 1, 4))) AS ticker, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS pe, p_brand AS brand FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(substr(p_name, 1, 4))) ORDER BY p_partkey) AS first FROM part) WHERE first = 1")
def fundamentals(spark, sf_dir):
    lake, path = _lake(spark), f"{_scratch(spark)}/csv"
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    raw = part.select(F.lower(F.substr("p_name", F.lit(1), F.lit(4))).alias("Symbol"), F.when(F.col("p_partkey") % 9 == 0, "n/a").otherwise(F.col("p_size").cast("string")).alias("pe"), F.col("p_brand").alias("brand"), "p_partkey")
    raw.coalesce(1).sortWithinPartitions("p_partkey").drop("p_partkey").write.csv(path, header=True)
    lake.take_fundamentals(spark.read.csv(path, header=True), "2024-01-01")
    return lake.table("fundamentals_snapshot").select("ticker", "pe", "brand")


@_query("SELECT article_id, ticker, CASE WHEN length(article_id) % 2 = 0 THEN len(replace(article_id, '1', '')) / CAST(length(article_id) AS DOUBLE) ELSE score_av END AS score_finbert, CASE WHEN length(article_id) % 2 = 0 THEN 'r1' ELSE 'r0' END AS finbert_revision FROM news WHERE score_av IS NOT NULL", ("news",))
def scored_articles(news_):
    even = F.length("article_id") % 2 == 0
    rows = news_.where("score_av is not null").select("article_id", "ticker", F.when(~even, F.col("score_av")).alias("score_finbert"), F.when(~even, "r0").alias("finbert_revision"))
    texts = news_.select("article_id").distinct().withColumns({"title": F.col("article_id"), "summary": F.lit("words")})
    open_ = ingest.pending(rows, "score_finbert", ["article_id", "ticker"])
    done = ingest.with_scores(open_, texts, ingest.scorer(lambda: lambda given: [len(t.split(". ")[0].replace("1", "")) / len(t.split(". ")[0]) for t in given]), "r1")
    return store.merged(rows, done.select(rows.columns), ["article_id", "ticker"])


@_query("WITH m AS (SELECT provider, dataset, ticker, max_by(started_at, (seq, started_at)) AS h FROM manifest WHERE status = 'ok' GROUP BY 1, 2, 3) SELECT provider, dataset, count(*) AS tickers, min(h) AS oldest, max(h) AS newest FROM m GROUP BY 1, 2", ("manifest",))
def lake_status(manifest):
    lake = _lake(manifest.sparkSession)
    marks = manifest.where("status = 'ok'").select("provider", "dataset", "ticker", F.col("started_at").alias("high_water_date"), "run_id", F.timestamp_seconds("seq").alias("updated_at"))
    store.append_log(marks, f"{lake.root}/state/watermarks")
    return lake.status()["watermarks"]


@_query("SELECT ticker, date, CASE WHEN date >= DATE '1996-01-01' THEN close / 2 ELSE close END AS close, CASE WHEN date >= DATE '1996-01-01' THEN volume * 2 ELSE volume END AS volume FROM bars WHERE date NOT IN (DATE '1996-01-03', DATE '1996-01-04')", ("bars",))
def synthetic_events(bars):
    return synthetic.without_sessions(synthetic.with_split(_priced(bars), "1996-01-01", 2.0), ["1996-01-03", "1996-01-04"]).select("ticker", "date", "close", "volume")


_STATEMENTS = {"select 1": True, "select * from bars;": True, "with a as (select 1 as x) select x from a": True, "drop table bars": False, "select * from other": False, "select 1; select 2": False, "insert into bars values (1)": False, "select java_method('a', 'b')": False, "select 'drop table' as w": True, "": False, "select * from parquet.`/x`": False, "explain select 1": False}


@_query("SELECT * FROM (VALUES " + ", ".join(f"('{s.replace(chr(39), chr(39) * 2)}', {str(ok).lower()})" for s, ok in _STATEMENTS.items()) + ") t(statement, allowed)")
def gate_verdicts(spark, sf_dir):
    def allowed(text: str) -> bool:
        try:
            gate.guard(spark, text, {"bars"})
        except gate.Rejected:
            return False
        return True

    return spark.createDataFrame([(s, allowed(s)) for s in _STATEMENTS], "statement string, allowed boolean")


@_query("""WITH b AS (SELECT ticker, date, close AS open, CASE WHEN volume % 7 = 0 THEN close - 3 ELSE close + 2 END AS high, close - 1 AS low, close, CASE WHEN volume % 11 = 0 THEN -volume ELSE volume END AS volume FROM bars)
SELECT c AS "check", count(*) AS n FROM (SELECT unnest([CASE WHEN high < low THEN 'high_ge_low' END, CASE WHEN high < open THEN 'high_ge_open' END, CASE WHEN high < close THEN 'high_ge_close' END, CASE WHEN volume < 0 THEN 'volume_nonnegative' END, CASE WHEN low <= 0 THEN 'low_positive' END, CASE WHEN high <= 0 THEN 'high_positive' END]) AS c FROM b) WHERE c IS NOT NULL GROUP BY 1""", ("bars",))
def quarantined(bars):
    lake = _lake(bars.sparkSession)
    bad = _priced(bars).withColumns({"high": F.when(F.col("volume") % 7 == 0, F.col("close") - 3).otherwise(F.col("high")), "volume": F.when(F.col("volume") % 11 == 0, -F.col("volume")).otherwise(F.col("volume")), "ingested_at": F.lit(EARLY)})
    lake.curate_bars(bad)
    return bars.sparkSession.read.parquet(f"{lake.root}/quarantine/ohlcv_daily").groupBy("check").agg(F.count("*").alias("n"))


@_query("SELECT ticker, CAST(date AS DATE) AS date, close, volume FROM bars", ("bars",))
def chart_payloads(bars):
    at = F.unix_date("date") * 86400 + 50_000
    rows = _priced(bars).groupBy("ticker").agg(F.collect_list(F.struct(at.alias("t"), *vendors.PRICES, "volume")).alias("b"))
    quote = F.struct(*(F.col(f"b.{c}").alias(c) for c in (*vendors.PRICES, "volume")))
    result = F.struct(F.col("b.t").alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators"))
    payloads = rows.select("ticker", F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart"))).alias("payload"))
    return vendors.history_bars(transports.chart_history(payloads)).select("ticker", "date", "close", "volume")


@_query("SELECT upper(substr(replace(p_name, ' ', ''), 1, 3 + CAST(p_partkey % 4 AS INT))) AS ticker, trim(p_name) AS security_name, p_brand AS market_category, CASE WHEN p_partkey % 19 = 0 THEN 'Y' ELSE 'N' END AS test_issue, 'N' AS financial_status, CAST(p_size AS DOUBLE) AS round_lot_size, 'N' AS etf, 'N' AS nextshares FROM part")
def nasdaq_directory(spark, sf_dir):
    part, path = spark.read.parquet(f"{sf_dir}/part.parquet"), f"{_scratch(spark)}/listed.txt"
    ticker = F.upper(F.substr(F.replace("p_name", F.lit(" "), F.lit("")), F.lit(1), (F.col("p_partkey") % 4 + 3).cast("int")))
    cells = F.concat_ws("|", ticker, "p_name", "p_brand", F.when(F.col("p_partkey") % 19 == 0, "Y").otherwise("N"), F.lit("N"), F.col("p_size").cast("string"), F.lit("N"), F.lit("N"))
    head = spark.createDataFrame([("|".join(files.NASDAQ),)], "value string")
    head.unionByName(part.select(cells.alias("value"))).coalesce(1).write.text(path)
    return files.read_listing(spark, path, files.NASDAQ)


@_query("SELECT ticker, min_by(seq, seq) AS seq FROM manifest GROUP BY ticker", ("manifest",))
def first_file_row(manifest):
    path = f"{_scratch(manifest.sparkSession)}/rows"
    manifest.select("ticker", "seq").coalesce(1).sortWithinPartitions("seq").write.csv(path, header=True)
    return dedupe.first_row_wins(manifest.sparkSession.read.csv(path, header=True, schema="ticker string, seq long"), ["ticker"])
