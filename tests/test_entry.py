from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = Path("/root/testdata/sf0.001")


def test_registers_queries_and_their_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


@pytest.mark.skipif(not SMALL.exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["adj_close", "flag_summary", "daily_ic", "reconcile_summary", "trading_day", "table_upsert", "promoted_files", "curated_news", "built_factor", "feed_articles", "chart_payloads", "general_payloads", "minute_payloads", "bulk_payloads", "scored_articles", "directory_refresh", "roster_refreshes", "validation_report", "reconciliation_run", "exported"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in SMALL.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    df = entry.queries()[name](spark, str(SMALL))
    want = con.execute(entry.oracle_sql()[name])
    order = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted(str(tuple(r)) for r in df.collect()) == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
