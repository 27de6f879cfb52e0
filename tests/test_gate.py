import time
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.operators import ingest, reports, research
from ledgerline.plans import gate


@pytest.fixture(scope="module")
def views(spark):
    facts = spark.createDataFrame([("A", 10.0, "tech", "1.5"), ("B", 20.0, "tech", None), ("C", 30.0, "food", "x"), ("D", 40.0, "tech", "2"), ("E", None, "", "3")], "ticker string, pe double, sector string, beta string")
    facts.createOrReplaceTempView("facts")
    return {"fundamentals_snapshot": facts, "universe_membership": spark.createDataFrame([("F",)], "ticker string")}


@pytest.mark.parametrize(
    "sql",
    [
        "select * from facts", "SELECT ticker, 'drop' AS x FROM facts; ", "with t as (select * from facts) select count(*) from t where pe > 1 -- set", "select * from facts where pe in (select max(pe) from facts)",
        "select ticker, percent_rank() over (order by pe) as p from facts", "select * from (values (1), (2)) v(x) union all select 3", "select sector, count(*) from facts group by sector having count(*) > 1 order by 1 limit 3", "select * from range(3)",
        "select f.ticker from facts f join lateral (select 1 as one) l", "select a.x from facts lateral view explode(array(1, 2)) a as x",
    ],
)
def test_reads_pass(spark, views, sql):
    spark.sql(gate.guard(spark, sql, {"facts"})).collect()


@pytest.mark.parametrize(
    "sql",
    [
        "", ";", "drop table facts", "insert into facts values (1)", "create view v as select 1", "set spark.x = 1", "select 1; select 2", "describe facts", "show tables", "use x", "explain select 1", "cache table facts", "add jar x", "refresh table facts",
        "select * from parquet.`/root`", "select * from csv.`/etc/passwd`", "select * from other", "select java_method('java.lang.System', 'exit', '0')", "select reflect('java.lang.System', 'getenv')", "select try_reflect('a', 'b')",
        "select * from facts where pe > (select max(x) from text.`/etc/passwd`)", "with t as (select * from text.`/etc/passwd`) select * from t", "select transform(ticker) using 'cat' as (x) from facts", "from facts insert overwrite directory '/tmp/x' select *",
        "select * from facts where exists (select 1 from hidden)", "with t as (select 1) select * from (select * from t) join u", "select a.x from facts lateral view java_method('a', 'b') a as x", "select * from values (java_method('a', 'b')) v(x)", "select identifier('java_method')('a', 'b')", "select * from identifier('hidden')", "execute immediate 'select 1'", "begin select 1; end", "delete from facts", "update facts set pe = 1", "merge into facts using facts f on true when matched then delete", "select * from f.g",
    ],
)
def test_others_are_rejected(spark, views, sql):
    with pytest.raises(gate.Rejected):
        gate.guard(spark, sql, {"facts"})
    assert gate.run_sql(spark, sql, views={"facts"}).startswith("REJECTED:")


def test_results_errors_and_time(spark, views):
    assert gate.run_sql(spark, "select ticker, pe from facts order by 1", rows=1, cols=1) == "ticker\nA\n(first 1 rows only)\n(first 1 of 2 columns)"
    assert gate.run_sql(spark, "select nothing from facts").startswith("SQL ERROR:")
    began = time.time()
    assert "stopped" in gate.run_sql(spark, "select count(*) from range(100000000000) a where hash(id, uuid()) = 5", seconds=2)
    assert time.time() - began < 60


def test_context_and_proposals(spark, views):
    text = gate.schema_context({"facts": views["fundamentals_snapshot"]})
    assert text.startswith("## facts\n- ticker: string (e.g. A, B)") and text == gate.schema_context({"facts": views["fundamentals_snapshot"]})
    rows = [("a", "fundamentals_snapshot", "pe", "10.05"), ("B", "fundamentals_snapshot", "pe", "25"), ("C", "fundamentals_snapshot", "beta", "1"), ("D", "fundamentals_snapshot", "none", "1"), ("Z", "gone", "pe", "1")]
    cited = spark.createDataFrame(rows, "ticker string, view string, column string, value string")
    got = {r.check: (r.passed, r.detail) for r in gate.verify_proposal(cited, views).collect()}
    assert got == {"tickers_exist": (False, "Z"), "sector_share": (False, "tech: 3 of 5"), "columns_exist": (False, "fundamentals_snapshot.none, gone.pe"), "figures": (False, "1 of 2 within the tolerance")}


def test_fetch_plan(spark):
    days = calendar.calendar_map(calendar.sessions(spark, "XNYS", date(2024, 1, 2), date(2024, 1, 31)))
    wanted = spark.createDataFrame([("p", "ohlcv", t) for t in "ABCD"], "provider string, dataset string, ticker string")
    marks = spark.createDataFrame([("p", "ohlcv", "A", date(2024, 1, 5)), ("p", "ohlcv", "B", date(2024, 1, 12)), ("p", "ohlcv", "C", date(2024, 1, 30))], "provider string, dataset string, ticker string, high_water_date date")
    plan = ingest.fetch_plan(wanted, marks, days, "2024-01-02", "2024-01-30")
    assert {r.ticker: r.start.day for r in plan.collect()} == {"A": 8, "B": 16, "D": 2}
    assert len({r.batch for r in ingest.batches(plan).collect()}) == 3
    done = spark.createDataFrame([("p", "corporate_actions", "A", "ok", date(2024, 1, 3), date(2024, 1, 9)), ("p", "ohlcv", "A", "ok", None, date(2024, 1, 9)), ("p", "ohlcv", "B", "failed", date(2024, 1, 3), date(2024, 1, 9)), ("p", "ohlcv", "C", "ok", date(2024, 1, 3), date(2024, 1, 9))], "provider string, dataset string, ticker string, status string, last_date date, end date")
    assert {(r.dataset, r.ticker): r.high_water_date.day for r in ingest.high_waters(done).collect()} == {("corporate_actions", "A"): 9, ("ohlcv", "C"): 3}
    assert ingest.day_plan("2024-01-01", "2024-01-03", 13) == ([date(2024, 1, 2), date(2024, 1, 3)], True)


def test_scores(spark):
    rows = spark.createDataFrame([("a", None, None), ("b", 0.5, "old"), ("c", None, None), ("d", None, None)], "article_id string, score_finbert double, finbert_revision string")
    articles = spark.createDataFrame([("a", "good", "news"), ("b", "x", "y"), ("c", " ", None)], "article_id string, title string, summary string")
    score = ingest.scorer(lambda: lambda texts: [float(len(t)) for t in texts], batch=1)
    got = {r.article_id: (r.score_finbert, r.finbert_revision) for r in ingest.with_scores(rows, articles, score, "r1").collect()}
    assert got == {"a": (10.0, "r1"), "b": (0.5, "old"), "c": (None, None), "d": (None, None)}
    assert [r.article_id for r in ingest.pending(rows, "score_finbert", ["article_id"], 2).collect()] == ["a", "c"]


def test_texts(spark):
    closes = spark.createDataFrame(pd.DataFrame([("A", date.fromordinal(738000 + i), 10.0 + i) for i in range(30)], columns=["ticker", "date", "close"])).withColumn("volume", F.lit(1))
    text = reports.basket_text(research.basket_metrics(closes, ["A"]))
    assert "| A |" in text and "| N/A |" in text and "| 0.3220 |" in text
    flags = spark.createDataFrame([("gap", "error", 2)], "flag_type string, severity string, n long")
    assert "| gap | error | 2 |" in reports.flags_text(flags, flags, "r1")
