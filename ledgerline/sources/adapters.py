"""The driver's tables in the shape of the domain: bars, actions, factors, rosters. Each is SQL text that Spark and DuckDB both run, so that results compare exactly.

A supplier is a ticker and a customer belongs to one supplier of fifteen, so tickers grow with the data while each has about 600 bars and a few actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> SQL over the driver's tables and over names above it.
FRAMES = {
    "bars": "SELECT concat('S', cast(l_suppkey AS string)) AS ticker, cast(l_shipdate AS date) AS date, cast(sum(cast(round(l_extendedprice * 100) AS bigint)) AS double) / cast(sum(cast(l_quantity AS bigint)) AS double) / 100 AS close, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS volume FROM lineitem GROUP BY 1, 2",
    "actions": "SELECT ticker, ex_date, 'split' AS action_type, cast(max(value) AS double) AS value FROM (SELECT concat('S', cast(cast(floor(o_custkey / 15) AS bigint) AS string)) AS ticker, cast(o_orderdate AS date) AS ex_date, 2 + o_orderkey % 2 AS value FROM orders WHERE o_orderkey % 97 = 0 UNION ALL SELECT concat('S', cast(cast(floor(o_custkey / 15) AS bigint) AS string)) AS ticker, cast(o_orderdate AS date) + 9 AS ex_date, 2 + o_orderkey % 2 AS value FROM orders WHERE o_orderkey % 291 = 0) s GROUP BY 1, 2 UNION ALL SELECT concat('S', cast(cast(floor(o_custkey / 15) AS bigint) AS string)) AS ticker, cast(o_orderdate AS date) AS ex_date, 'dividend' AS action_type, cast(max(o_orderkey % 50) + 1 AS double) / 10 AS value FROM orders WHERE o_orderkey % 89 = 5 GROUP BY 1, 2",
    "sessions": "SELECT DISTINCT 'TEST' AS calendar, cast(l_shipdate AS date) AS session FROM lineitem WHERE l_shipdate IS NOT NULL",
    "factor": "SELECT concat('S', cast(l_suppkey AS string)) AS ticker, cast(l_shipdate AS date) AS date, cast(max(cast(round(l_extendedprice * 100) AS bigint) % 100000) AS double) / 50000 - 1 AS score, cast(count(*) AS int) AS n_articles FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1, 2",
    "news": "SELECT concat('a', cast(o_orderkey AS string)) AS article_id, concat('S', cast(cast(floor(o_custkey / 15) AS bigint) AS string)) AS ticker, cast(o_orderdate AS date) AS date, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE cast(o_orderkey % 5 + 1 AS double) / 5 END AS relevance, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cast(o_orderkey % 201 - 100 AS double) / 100 END AS score_av FROM orders",
    "membership": "SELECT 'IDX' AS index_name, concat('C', cast(c_custkey AS string)) AS ticker, cast(date '2000-01-01' + cast(c_custkey % 900 AS int) AS date) AS effective_from, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE cast(date '2000-01-01' + cast(c_custkey % 900 + c_custkey % 700 + 1 AS int) AS date) END AS effective_to FROM customer",
    "directory": "SELECT upper(substr(replace(p_name, ' ', ''), 1, 3 + cast(p_partkey % 4 AS int))) AS ticker, concat(p_name, CASE WHEN p_partkey % 5 = 0 THEN ' Warrants' WHEN p_partkey % 7 = 0 THEN ' Preferred' ELSE ' Common' END) AS security_name, CASE WHEN p_partkey % 13 = 0 THEN 'Y' ELSE 'N' END AS test_issue, CASE WHEN p_partkey % 9 = 0 THEN 'Y' ELSE 'N' END AS etf, CASE WHEN p_partkey % 17 = 0 THEN 'E' WHEN p_partkey % 3 = 0 THEN 'D' ELSE 'N' END AS financial_status, p_partkey FROM part",
    "master": "SELECT concat('C', cast(c_custkey AS string)) AS ticker, c_mktsegment AS sector, cast(c_nationkey AS string) AS exchange, date '2020-01-01' AS effective_from, CASE WHEN c_custkey % 10 = 0 THEN date '2021-01-01' ELSE NULL END AS effective_to FROM customer WHERE c_custkey % 6 <> 0",
    "snapshot": "SELECT concat('C', cast(c_custkey AS string)) AS ticker, CASE WHEN c_custkey % 8 = 0 THEN 'MOVED' ELSE c_mktsegment END AS sector, cast(c_nationkey AS string) AS exchange FROM customer WHERE c_custkey % 5 <> 0",
    "manifest": "SELECT concat('run', cast(o_orderkey % 40 AS string)) AS run_id, CASE WHEN o_orderkey % 2 = 0 THEN 'p' ELSE 'q' END AS provider, 'ohlcv' AS dataset, concat('C', cast(o_custkey AS string)) AS ticker, CASE WHEN o_orderkey % 9 = 0 THEN 'failed' ELSE 'ok' END AS status, cast(o_orderkey % 300 AS bigint) AS rows_fetched, cast(o_orderdate AS date) AS started_at, o_orderkey AS seq FROM orders",
}

def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain frame from the tables in a folder; the tables are read under names of their own, so that queries don't meet."""
    text = FRAMES[name]
    views = {}
    for table in ("lineitem", "orders", "customer", "part"):
        if f"FROM {table}" in text:
            views[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    for table in views:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **views)


def with_frames(*names: str) -> str:
    """A WITH clause for DuckDB that defines those frames."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({FRAMES[n]})" for n in names)
