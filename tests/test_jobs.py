from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.plans.jobs import Lake
from ledgerline.sources import synthetic


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), calendar.sessions(spark, "XNYS", date(2024, 1, 2), date(2024, 3, 28)))


def test_bars_from_fetch_to_views(spark, lake):
    synthetic.register(spark)
    days = calendar.calendar_map(lake.sessions)
    wanted = spark.createDataFrame([("synthetic", "ohlcv_daily", t) for t in ("AA", "BB", "CC")], "provider string, dataset string, ticker string")

    def fetch(plan):
        bars = spark.read.format("synthetic_bars").options(tickers="AA,BB", start="2024-01-02", end="2024-03-28").load()
        return bars.join(plan.select("ticker", "start", "end"), "ticker").where("date between start and end").drop("start", "end").withColumn("source", F.lit("synthetic"))

    run = lake.ingest("synthetic", "ohlcv_daily", fetch, wanted, days, "2024-01-02", "2024-02-29")
    assert {r.ticker: r.rows_fetched for r in run.collect()} == {"AA": 41, "BB": 41, "CC": 0}
    again = lake.ingest("synthetic", "ohlcv_daily", fetch, wanted, days, "2024-01-02", "2024-03-05")
    assert {r.ticker: (r.start, r.rows_fetched) for r in again.collect()} == {"AA": (date(2024, 3, 1), 3), "BB": (date(2024, 3, 1), 3), "CC": (date(2024, 1, 2), 0)}
    raw = spark.read.parquet(f"{lake.root}/raw").where("date <> '2024-02-01'")
    bad = raw.limit(1).withColumn("high", F.lit(-1.0)).withColumn("date", F.lit("2024-02-01").cast("date"))
    assert lake.curate_bars(raw.unionByName(bad))["rows_new"] == 86
    assert lake.curate_actions(spark.createDataFrame([("aa", "2024-02-15", "split", "2", datetime(2024, 3, 1))], "ticker string, ex_date string, action_type string, value string, ingested_at timestamp"))["rows_in"] == 1
    assert spark.read.parquet(f"{lake.root}/quarantine/ohlcv_daily").where("check = 'high_positive'").count() == 1
    assert "2" in lake.query("select count(*) as n from validation_flags where flag_type = 'missing_session'").splitlines()[1]
    first = spark.sql("select close, close_raw from ohlcv_daily_adj where ticker = 'AA' and date = '2024-01-02'").first()
    assert first.close == pytest.approx(first.close_raw / 2)
    assert lake.query("drop table x").startswith("REJECTED")
    status = lake.status()
    assert [tuple(r) for r in status["watermarks"].collect()] == [("synthetic", "ohlcv_daily", 2, date(2024, 3, 5), date(2024, 3, 5))] and status["runs"].count() == 2


def test_news_to_factors(spark, lake):
    t = datetime(2024, 1, 3, 15, 0)
    aid = "a" * 64
    schema = "article_id string, published_at timestamp, ingested_at timestamp, source string, provider string, title string, summary string, url string, overall_sentiment_score double, ticker string, relevance double, score_av double"
    one = (aid, t, t, "s", "p", "ti", "su", "u", 0.1, "AA", 0.5, 0.4)
    later = (aid, t, datetime(2024, 1, 9), "s", "p", "other", "su", "u", 0.1, "AA", 0.5, -1.0)
    assert lake.curate_news(spark.createDataFrame([later, one], schema))["tickers"]["rows_in"] == 1
    assert lake.curate_news(spark.createDataFrame([later], schema))["articles"]["rows_in"] == 0
    from ledgerline.operators import ingest

    lake.score_news(ingest.scorer(lambda: lambda texts: [0.25 for _ in texts]), "r1")
    lake.build_sentiment(calendar.calendar_map(lake.sessions))
    assert [(r.ticker, r.date, r.sent_av, r.sent_finbert) for r in lake.table("sentiment_daily").collect()] == [("AA", date(2024, 1, 3), 0.4, 0.25)]


def test_rosters_master_and_fundamentals(spark, lake):
    target = lambda *t: spark.createDataFrame([("X", x) for x in t], "index_name string, ticker string")
    lake.refresh_roster(target("A", "B"), "2024-01-02", "dir")
    lake.refresh_roster(target("B", "C"), "2024-02-01", "dir")
    lake.refresh_roster(target("B", "C"), "2024-02-01", "dir")
    got = {(r.ticker, r.effective_from.month, r.effective_to and r.effective_to.month) for r in lake.table("universe_membership").collect()}
    assert got == {("A", 1, 2), ("B", 1, None), ("C", 2, None)}
    rows = spark.createDataFrame([("A", "N", "tech", "", "", "")], "ticker string, exchange string, gic_sector string, gic_group string, gic_industry string, gic_sub_industry string")
    lake.refresh_master(rows, "2024-01-02")
    lake.refresh_master(rows.withColumn("gic_sector", F.lit("food")), "2024-02-01")
    assert {(r.gic_sector, r.effective_to and r.effective_to.month) for r in lake.table("security_master").collect()} == {("tech", 2), ("food", None)}
    raw = spark.createDataFrame([("a", "1.5", "tech"), ("b", "n/a", "food")], "symbol string, pe string, sector string")
    lake.take_fundamentals(raw, "2024-01-02")
    assert {(r.ticker, r.pe) for r in lake.table("fundamentals_snapshot").collect()} == {("A", 1.5), ("B", None)}


def bars_for(plan, spark, close=10.0):
    days = plan.select("ticker", F.explode(F.sequence("start", "end")).alias("date"))
    return days.select("ticker", "date", *(F.lit(x).alias(c) for c, x in (("open", close), ("high", close + 1), ("low", close - 1), ("close", close))), F.lit(100).cast("long").alias("volume"))


def test_a_failure_is_a_tickers_own(spark, lake):
    wanted = spark.createDataFrame([("v", "ohlcv_daily", t) for t in ("AA", "BAD", "CC")], "provider string, dataset string, ticker string")
    asked = []

    def fetch(plan):
        names = [r.ticker for r in plan.collect()]
        asked.append(names)
        if "BAD" in names:
            raise ValueError("no such symbol")
        early = plan.withColumn("start", F.date_sub("start", 3))
        return bars_for(early, spark)

    run = lake.ingest("v", "ohlcv_daily", fetch, wanted, calendar.calendar_map(lake.sessions), "2024-01-04", "2024-01-10")
    assert {r.ticker: (r.status, r.rows_fetched) for r in run.collect()} == {"AA": ("ok", 7), "BAD": ("failed", 0), "CC": ("ok", 7)}
    assert asked[0] == ["AA", "BAD", "CC"] or sorted(asked[0]) == ["AA", "BAD", "CC"]
    assert [r.error for r in lake.failures(run.first().run_id).collect()] == ["ValueError: no such symbol"]
    assert lake.raw_frame("v", "ohlcv_daily").agg(F.min("date")).first()[0] == date(2024, 1, 4)


def test_reconcile_export_and_reports(spark, lake, tmp_path):
    wanted = lambda p: spark.createDataFrame([(p, "ohlcv_daily", "AA")], "provider string, dataset string, ticker string")
    for p, close in (("a", 10.0), ("b", 10.02)):
        lake.ingest(p, "ohlcv_daily", lambda plan, c=close: bars_for(plan, spark, c), wanted(p), calendar.calendar_map(lake.sessions), "2024-01-04", "2024-01-08")
    assert "within_tolerance" in lake.reconcile("a", "b")
    lake.curate("ohlcv_daily")
    lake.validate(run_id="r")
    assert lake.validation_report("r").startswith("# Validation r") and (tmp_path / "lake/reports/validation-r.md").exists()
    assert spark.read.csv(lake.export("select ticker, count(*) as n from ohlcv_daily group by ticker", str(tmp_path / "out.csv")), header=True).collect()[0]["n"] == "5"
    assert "| AA |" in lake.basket(["AA", "ZZ"]) and lake.one_pager("AA").startswith("# AA")
    with pytest.raises(ValueError, match="no raw"):
        lake.latest_raw("c", "ohlcv_daily")


def test_news_stream_stops_at_the_first_failure(spark, lake):
    item = {"title": "t", "url": "http://x/1", "time_published": "20240103T150000", "summary": "s", "source": "q", "overall_sentiment_score": 0.2, "ticker_sentiment": [{"ticker": "AA", "relevance_score": "0.5", "ticker_sentiment_score": "0.3"}]}

    def fetch(day):
        if day == date(2024, 1, 5):
            raise ValueError("quota")
        return ([item, item] if day == date(2024, 1, 3) else []), True

    got = lake.ingest_news(fetch, "2024-01-06", "2024-01-03")
    assert (got["days"], got["articles"], got["error"]) == (2, 2, "ValueError: quota")
    asked = []
    lake.ingest_news(lambda d: (asked.append(d) or [], True), "2024-01-06", "2024-01-03")
    assert asked == [date(2024, 1, 5), date(2024, 1, 6)]
    assert lake.curate("news")["tickers"]["rows_in"] == 1
    lake.build_sentiment(calendar.calendar_map(lake.sessions))
    assert "n_dates" in lake.research()


def test_directories_and_commands(spark, lake, tmp_path):
    from ledgerline import cli
    from ledgerline.sources import files

    def text(*rows):
        path = tmp_path / f"{len(rows)}.txt"
        path.write_text("\n".join(["|".join(files.NASDAQ), *("|".join((t, f"{t} Common", "Q", "N", "N", "100", "N", "N")) for t in rows), "File Creation Time: 0101|||||||"]))
        return str(path)

    said = []
    run = lambda *argv: cli.run(spark, ["--root", lake.root, *argv], said.append)
    run("refresh", "--file", text("AA", "BB"), "--as-of", "2024-01-02", "--index", "X")
    run("refresh", "--file", text("BB", "CC", "DD"), "--as-of", "2024-02-01", "--index", "X")
    assert [r[0] for r in lake.members("X", "2024-01-15").orderBy("ticker").collect()] == ["AA", "BB"]
    assert [r[0] for r in lake.members("X", "2024-02-15").orderBy("ticker").collect()] == ["BB", "CC", "DD"]
    run("seed", "AA,EE", "--as-of", "2024-02-01", "--index", "Y")
    run("ingest", "bars", "--tickers", "AA,EE", "--start", "2024-01-02", "--end", "2024-01-31")
    run("curate", "bars")
    run("validate")
    run("query", "select count(*) as n from ohlcv_daily")
    run("status")
    assert any("| ok | 2 |" in s for s in said) and any("Validation full" in s for s in said) and lake.table("listing").count() == 5


def test_screening_talks(spark):
    from ledgerline.plans import agents

    facts = spark.createDataFrame([("AA", 10.0, "x"), ("BB", 20.0, "y")], "ticker string, pe double, sector string")
    good = [{"ticker": "AA", "view": "fundamentals_snapshot", "column": "pe", "value": 10.0}]
    said = iter(['{"sql": "select ticker, pe from fundamentals_snapshot"}', "words", '{"proposal": [{"ticker": "ZZ", "view": "fundamentals_snapshot", "column": "pe", "value": 1}]}', f'{{"proposal": {__import__("json").dumps(good)}}}'])
    meter = agents.UsageMeter()
    case = agents.screen(spark, "cheap names", {"fundamentals_snapshot": facts}, lambda messages: agents.Reply(next(said), 5, 2), lambda messages: 1 / 0, meter=meter)
    assert case.passed and case.proposal == good and "AA | 10.0" in case.queries[0][1] and meter.tokens_in == 20
    assert "Outcome: passed" in agents.case_text(spark, case, meter)
    late = agents.screen(spark, "t", {"fundamentals_snapshot": facts}, lambda m: agents.Reply("{}"), turns=2)
    assert late.error and not late.passed


def test_requests_fail_alone(spark):
    from ledgerline.sources import transports, vendors

    def send(url):
        if "BAD" in url:
            raise ValueError("unknown")
        return '{"chart":{"result":[{"timestamp":[1704205800],"events":{"dividends":{"1":{"amount":0.5,"date":1704205800}}},"indicators":{"quote":[{"open":[1.0],"high":[2.0],"low":[0.5],"close":[1.5],"volume":[9]}]}}]}}'

    transports.register(spark, send)
    got = transports.requested(spark, "history", ["AA", "BAD"], start="2024-01-02", end="2024-01-02", per_minute=60000)
    assert {r.ticker: r.error for r in got.collect()} == {"AA": None, "BAD": "ValueError: unknown"}
    wide = transports.chart_history(got)
    assert [(r.ticker, r.date, r.close, r.volume) for r in vendors.history_bars(wide).collect()] == [("AA", date(2024, 1, 2), 1.5, 9)]
    assert [(r.action_type, r.value) for r in vendors.history_actions(wide).collect()] == [("dividend", 0.5)]
    assert [(a.day, b.day) for a, b in transports.spans(date(2024, 1, 1), date(2024, 1, 5), 2)] == [(1, 2), (3, 4), (5, 5)]
    pages = iter(['{"feed": %s}' % str([{"time_published": "20240102T100000"}] * 1000).replace("'", '"'), '{"feed": []}'])
    items, whole = transports.paged_day(date(2024, 1, 2), lambda url: next(pages))
    assert len(items) == 1000 and whole
