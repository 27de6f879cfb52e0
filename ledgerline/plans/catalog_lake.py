"""Queries of whole runs of the lake's jobs (refreshes of rosters, validation, reconciliation, exports), with the same in DuckDB's SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans.catalog import _FLAGS, _query, _r
from ledgerline.plans.catalog_jobs import EARLY, _lake, _priced
from ledgerline.sources import files, store

_LETTERS = "translate(cast(p_partkey AS {text}), '0123456789', 'ABCDEFGHIJ')"
_COMMON = "test_issue = 'N' AND etf = 'N' AND NOT regexp_matches(lower(security_name), 'warrant|right|unit|preferred|notes|debenture|bond') AND regexp_full_match(ticker, '[A-Z]{1,5}')"
#: The directory with tickers that are nearly all different.
_NAMED = f"d AS (SELECT * REPLACE ({_LETTERS.format(text='VARCHAR')} AS ticker) FROM directory)"


def _lines(directory: DataFrame, names: dict[str, str], cells: dict[str, object], where: str) -> DataFrame:
    """A directory file's lines for some of its rows: a header, a line a row, a footer."""
    spark = directory.sparkSession
    row = F.concat_ws("|", *(F.coalesce(cells[c], F.lit("")) if c in cells else F.lit("") for c in names.values()))
    edge = lambda text: spark.createDataFrame([(text,)], "value string")
    return edge("|".join(names)).unionByName(directory.where(where).select(row.alias("value"))).unionByName(edge(f"{files.FOOTER}: 0101202400:00|||||||"))


def _cells(directory: DataFrame) -> dict[str, object]:
    return {c: F.col(c) for c in ("security_name", "test_issue", "etf", "financial_status")} | {"ticker": F.expr(_LETTERS.format(text="string")), "round_lot_size": F.lit("100")}


@_query(
    f"""WITH {_NAMED}, k AS (SELECT ticker, bool_or(p_partkey % 5 <> 0) AS b, bool_or(p_partkey % 5 <> 1) AS c FROM d WHERE {_COMMON} AND financial_status IN ('N', 'D') GROUP BY 1)
SELECT 'LISTED' AS index_name, ticker, DATE '2024-01-01' AS effective_from, CASE WHEN NOT b THEN DATE '2024-02-01' WHEN NOT c THEN DATE '2024-03-01' END AS effective_to, 'directory' AS source FROM k
UNION ALL SELECT 'LISTED', ticker, DATE '2024-03-01', NULL, 'directory' FROM k WHERE c AND NOT b""",
    ("directory",),
)
def directory_refresh(directory):
    lake = _lake(directory.sparkSession)
    for day, where in (("2024-01-01", "true"), ("2024-02-01", "p_partkey % 5 <> 0"), ("2024-03-01", "p_partkey % 5 <> 1")):
        lake.refresh_directory(_lines(directory, files.NASDAQ, _cells(directory), where), files.NASDAQ, day, "LISTED")
    return lake.table("universe_membership").select("index_name", "ticker", "effective_from", "effective_to", "source")


@_query(
    f"""WITH {_NAMED}, k AS (SELECT ticker, ['NYSE', 'ARCA', 'AMEX', 'CBOE', NULL][1 + p_partkey % 5] AS index_name, bool_or(p_partkey % 3 <> 0) AS stays FROM d WHERE {_COMMON} GROUP BY 1, 2)
SELECT index_name, ticker, DATE '2024-01-01' AS effective_from, CASE WHEN index_name IN ('NYSE', 'ARCA') AND NOT stays THEN DATE '2024-02-01' END AS effective_to FROM k WHERE index_name IS NOT NULL""",
    ("directory",),
)
def roster_refreshes(directory):
    """Four rosters from one directory; a later file that names two exchanges only leaves the other two as they were."""
    lake = _lake(directory.sparkSession)
    code = F.get(F.array(*(F.lit(c) for c in "NPAZX")), (F.col("p_partkey") % 5).cast("int"))
    for day, where in (("2024-01-01", "true"), ("2024-02-01", "p_partkey % 3 <> 0 and p_partkey % 5 < 2")):
        lake.refresh_directory(_lines(directory, files.OTHER, _cells(directory) | {"exchange": code}, where), files.OTHER, day)
    return lake.table("universe_membership").select("index_name", "ticker", "effective_from", "effective_to")


_RUN_FLAGS = _FLAGS.replace("> 3)", "> 8)")


@_query(
    f"""WITH {_RUN_FLAGS}, s AS (SELECT flag_type, severity, count(*) AS n FROM flags GROUP BY 1, 2), t AS (SELECT ticker, count(*) AS n FROM flags GROUP BY 1 ORDER BY n DESC, ticker LIMIT 10)
SELECT '# Validation r1' AS line UNION ALL SELECT '## Most flagged' UNION ALL SELECT '| flag_type | severity | n |' UNION ALL SELECT '| ticker | n |'
UNION ALL SELECT concat('| ', flag_type, ' | ', severity, ' | ', n, ' |') FROM s UNION ALL SELECT concat('| ', ticker, ' | ', n, ' |') FROM t""",
    ("bars", "actions", "sessions"),
)
def validation_report(bars, actions, sessions):
    """A run's flags go into their table; its report is read back line by line."""
    lake = _lake(bars.sparkSession, sessions)
    lake._put("ohlcv_daily", _priced(bars).withColumns({"year": F.year("date"), "ingested_at": F.lit(EARLY)}))
    lake._put("corporate_actions", actions.withColumn("ingested_at", F.lit(EARLY)))
    lake.validate(run_id="r1")
    lake.validation_report("r1")
    lines = bars.sparkSession.read.text(f"{lake.root}/reports/validation-r1.md")
    return lines.where("value <> '' and not startswith(value, '|---')").select(F.col("value").alias("line"))


@_query(
    """SELECT ticker, date, 'close' AS field, close AS value_a, close * 1.02 AS value_b, round(abs(close - close * 1.02) / (close * 1.02), 9) + 0.0 AS rel_diff, 'discrepancy' AS classification FROM bars WHERE volume % 13 <> 0 AND volume % 9 = 0
UNION ALL SELECT ticker, date, 'volume', CAST(volume AS DOUBLE), CAST(volume + 1 AS DOUBLE), round(CAST(1 AS DOUBLE) / (volume + 1), 9), CASE WHEN CAST(1 AS DOUBLE) / (volume + 1) <= 0.1 THEN 'within_tolerance' ELSE 'discrepancy' END FROM bars WHERE volume % 13 <> 0 AND volume % 4 = 0
UNION ALL SELECT ticker, date, NULL, NULL, NULL, NULL, 'missing_in_b' FROM bars WHERE volume % 13 = 0""",
    ("bars",),
)
def reconciliation_run(bars):
    """Two vendors' raw bars, the later capture of one counting, through the job that keeps its rows."""
    lake = _lake(bars.sparkSession)
    volume = F.col("volume")
    b = _priced(bars).where(volume % 13 != 0).withColumns({"close": F.when(volume % 9 == 0, F.col("close") * 1.02).otherwise(F.col("close")), "volume": F.when(volume % 4 == 0, volume + 1).otherwise(volume)})
    for provider, day, rows in (("a", 1, _priced(bars).withColumn("close", F.col("close") + 7)), ("a", 2, _priced(bars)), ("b", 1, b)):
        store.write_raw(rows.withColumn("ingested_at", F.lit(datetime(2024, 1, day))), lake.root, provider, "ohlcv_daily", f"{provider}{day}")
    lake.reconcile("a", "b")
    kept = bars.sparkSession.read.option("recursiveFileLookup", "true").parquet(f"{lake.root}/reconciliation")
    return _r(kept.drop("run_id"), 9, "rel_diff")


@_query(
    "WITH x AS (SELECT ticker, max(close) AS high, count(*) AS n FROM bars WHERE volume % 2 = 0 GROUP BY 1) SELECT kind, ticker, high, n FROM x, (SELECT unnest(['parquet', 'csv']) AS kind)",
    ("bars",),
)
def exported(bars):
    """A gated statement's whole result as Parquet and as CSV, both read back."""
    lake, spark = _lake(bars.sparkSession), bars.sparkSession
    lake._put("ohlcv_daily", _priced(bars).withColumns({"year": F.year("date"), "ingested_at": F.lit(EARLY)}))
    sql = "SELECT ticker, max(close) AS high, count(*) AS n FROM ohlcv_daily WHERE volume % 2 = 0 GROUP BY ticker"
    parquet = spark.read.parquet(lake.export(sql, f"{lake.root}/out.parquet"))
    csv = spark.read.csv(lake.export(sql, f"{lake.root}/out.csv"), header=True, schema="ticker string, high double, n bigint")
    return parquet.withColumn("kind", F.lit("parquet")).unionByName(csv.withColumn("kind", F.lit("csv"))).select("kind", "ticker", "high", "n")
