"""Queries of as-of joins, of statistics over a date's names and of streams that take files once, with the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import asof
from ledgerline.plans.catalog import _query

_MICROS = 86_400_000_000


def _shop(spark, sf_dir):
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet").select("click_id", "client_id", "ts")
    sales = spark.read.parquet(f"{sf_dir}/sales.parquet").select("client_id", "sale_id", "total", "sold_at")
    return clicks, sales


#: Of sales of one client at one moment the one with the largest number, then total.
_SALES = "s AS (SELECT client_id, sold_at, max((sale_id, total)) AS x FROM sales WHERE sold_at IS NOT NULL AND client_id IS NOT NULL GROUP BY 1, 2), s2 AS (SELECT client_id, sold_at, x[1] AS sale_id FROM s)"


@_query(f"WITH {_SALES} SELECT c.click_id, c.client_id, c.ts, s2.sale_id, s2.sold_at FROM clicks c ASOF LEFT JOIN s2 ON c.client_id = s2.client_id AND c.ts >= s2.sold_at")
def asof_backward(spark, sf_dir):
    clicks, sales = _shop(spark, sf_dir)
    return asof.asof_join(clicks, sales, ["client_id"], "ts", "sold_at", ["sale_id", "sold_at"], order=["sale_id", "total"])


@_query(f"WITH {_SALES}, j AS (SELECT c.click_id, c.client_id, c.ts, s2.sale_id, s2.sold_at FROM clicks c ASOF LEFT JOIN s2 ON c.client_id = s2.client_id AND c.ts < s2.sold_at) SELECT click_id, client_id, ts, CASE WHEN sold_at - ts <= INTERVAL 2 DAY THEN sale_id END AS sale_id, CASE WHEN sold_at - ts <= INTERVAL 2 DAY THEN sold_at END AS sold_at FROM j")
def asof_forward(spark, sf_dir):
    """The first sale after each click, within two days."""
    clicks, sales = _shop(spark, sf_dir)
    return asof.asof_join(clicks, sales, ["client_id"], "ts", "sold_at", ["sale_id", "sold_at"], asof.FORWARD, True, 2 * _MICROS, order=["sale_id", "total"])


@_query(f"""WITH {_SALES}, b AS (SELECT c.*, s2.sale_id, s2.sold_at FROM (SELECT click_id, client_id, ts, row_number() OVER () AS k FROM clicks) c ASOF LEFT JOIN s2 ON c.client_id = s2.client_id AND c.ts >= s2.sold_at),
f AS (SELECT b.*, s2.sale_id AS next_id, s2.sold_at AS next_at FROM b ASOF LEFT JOIN s2 ON b.client_id = s2.client_id AND b.ts <= s2.sold_at)
SELECT click_id, client_id, ts, CASE WHEN next_at IS NULL OR ts - sold_at <= next_at - ts THEN sale_id ELSE next_id END AS sale_id, CASE WHEN next_at IS NULL OR ts - sold_at <= next_at - ts THEN sold_at ELSE next_at END AS sold_at FROM f""")
def asof_nearest(spark, sf_dir):
    clicks, sales = _shop(spark, sf_dir)
    return asof.asof_join(clicks, sales, ["client_id"], "ts", "sold_at", ["sale_id", "sold_at"], asof.NEAREST, order=["sale_id", "total"])


@_query("""WITH n AS (SELECT ticker, date, score, n_articles FROM factor WHERE score IS NOT NULL), q AS (SELECT date, quantile_cont(score, 0.05) AS lo, quantile_cont(score, 0.95) AS hi FROM n GROUP BY 1),
w AS (SELECT n.*, least(greatest(score, lo), hi) AS drawn FROM n JOIN q USING (date)),
z AS (SELECT ticker, date, score, count(*) OVER d AS n, percent_rank() OVER (PARTITION BY date ORDER BY score) AS rank_share, score - avg(score) OVER d AS dev, stddev_samp(score) OVER d AS s, drawn - avg(drawn) OVER d AS wdev, stddev_samp(drawn) OVER d AS ws FROM w WINDOW d AS (PARTITION BY date))
SELECT ticker, date, score, n, round(rank_share, 9) AS rank_share, round(dev / nullif(round(s, 12), 0), 6) + 0.0::DOUBLE AS z, round(wdev / nullif(round(ws, 12), 0), 6) + 0.0::DOUBLE AS z_winsor FROM z""", ("factor",))
def cross_section(factor):
    from ledgerline.operators import cross_section as cs

    out = cs.scores(factor.select("ticker", "date", "score"), "score", tails=0.05)
    return out.withColumns({"rank_share": F.round("rank_share", 9), "z": F.round("z", 6) + F.lit(0.0), "z_winsor": F.round("z_winsor", 6) + F.lit(0.0)})


@_query("SELECT article_id, ticker, CASE WHEN length(article_id) % 2 = 0 THEN score_av ELSE relevance END AS v FROM news", ("news",))
def first_capture_stream(news_):
    """Three drops of files through keyed state: what the first one that holds a key says stays, of its rows the earliest."""
    from ledgerline.plans.catalog_jobs import EARLY, LATE, _scratch
    from ledgerline.sources import store
    from ledgerline.streaming import first_capture

    spark, root = news_.sparkSession, _scratch(news_.sparkSession)
    shaped = lambda rows, v, at: rows.select("article_id", "ticker", v.cast("double").alias("v"), F.lit(at).alias("ingested_at"))
    drops = [
        shaped(news_.where("length(article_id) % 2 = 0"), F.col("score_av"), LATE),
        shaped(news_, F.lit(7.0), LATE).unionByName(shaped(news_, F.col("relevance"), EARLY)),
        shaped(news_, F.lit(9.0), EARLY),
    ]
    for n, drop in enumerate(drops):
        drop.write.parquet(f"{root}/raw/{n}")
        first_capture.promote_first(spark, f"{root}/raw", "article_id string, ticker string, v double, ingested_at timestamp", f"{root}/t", f"{root}/c", ["article_id"], "ingested_at")
    return store.read_table(spark, f"{root}/t").select("article_id", "ticker", "v")


@_query("SELECT 0::BIGINT AS batch, count(*) AS rows_read, 1 AS runs FROM bars UNION ALL SELECT 1, count(*), 1 FROM bars WHERE volume % 4 = 0", ("bars",))
def promotion_ledger(bars):
    """Two drops of raw bars, curated after each: the second run reads the second drop alone, a third run reads nothing."""
    import uuid

    from ledgerline.plans.catalog_jobs import EARLY, LATE, _lake, _priced
    from ledgerline.sources import store

    lake = _lake(bars.sparkSession)
    for when, rows in ((EARLY, bars), (LATE, bars.where("volume % 4 = 0"))):
        store.write_raw(_priced(rows).withColumn("ingested_at", F.lit(when)), lake.root, "p", "ohlcv_daily", uuid.uuid4().hex)
        lake.curate("ohlcv_daily", "p", files=10_000)
    lake.curate("ohlcv_daily", "p", files=10_000)
    return lake.promotions().select("batch", "rows_read", F.size("run_ids").alias("runs"))
