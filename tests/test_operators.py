import re
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.operators import adjust, dedupe, detect, news, research, tables

D = date.fromisoformat


def bars(spark, closes, ticker="A", start="2024-01-01", volume=100):
    return spark.createDataFrame([(ticker, date.fromordinal(D(start).toordinal() + i), float(c), volume) for i, c in enumerate(closes)], "ticker string, date date, close double, volume long")


def actions(spark, rows):
    return spark.createDataFrame([("A", D(d), kind, float(v)) for d, kind, v in rows], "ticker string, ex_date date, action_type string, value double")


def test_no_backfill_in_source():
    root = Path(__file__).resolve().parents[1] / "ledgerline"
    assert not [p for p in root.rglob("*.py") if re.search(r"bfill|backfill", p.read_text())]


def test_splits_chain_against_the_last_kept(spark):
    rows = actions(spark, [("2024-01-01", "split", 2), ("2024-01-16", "split", 2), ("2024-01-31", "split", 2), ("2024-01-05", "split", 3)])
    got = {(r.ex_date.isoformat(), r.ratio) for r in adjust.dedupe_splits(rows).collect()}
    assert got == {("2024-01-01", 2.0), ("2024-01-31", 2.0), ("2024-01-05", 3.0)}


def test_factors_and_their_inverse(spark):
    b = bars(spark, [100, 100, 50, 50])
    a = actions(spark, [("2024-01-03", "split", 2), ("2024-01-04", "dividend", 5)])
    got = {r.date.day: (r.split_factor, round(r.div_factor, 6)) for r in adjust.adjustment_factors(b, a).collect()}
    assert got == {1: (0.5, 0.9), 2: (0.5, 0.9), 3: (1.0, 0.9), 4: (1.0, 1.0)}
    adjusted = adjust.adjusted_view(b, adjust.adjustment_factors(b, a.where("action_type = 'split'")))
    back = adjust.as_traded(adjusted.select("ticker", "date", "close", "volume"), a)
    assert [(r.close, r.volume) for r in back.orderBy("date").collect()] == [(100, 100), (100, 100), (50, 100), (50, 100)]


def test_dividend_without_a_prior_bar_is_skipped(spark):
    b, a = bars(spark, [10, 10]), actions(spark, [("2024-01-01", "dividend", 1)])
    assert {r.div_factor for r in adjust.adjustment_factors(b, a).collect()} == {1.0}


def test_appending_a_day_changes_no_past_flag(spark):
    closes = [100 + (i * 7919 % 13) / 10 for i in range(90)] + [150] + [100] * 8
    one, two = (detect.mad_outliers(bars(spark, c), 20, 5.0) for c in (closes, [*closes, 300]))
    assert set(one.collect()) <= set(two.collect()) and one.count() >= 2


def test_runs_and_gaps(spark):
    b = bars(spark, [1, 1, 1, 1, 1, 2, 3]).withColumn("volume", F.when(F.dayofmonth("date") > 4, 0).otherwise(5))
    assert detect.stale_prices(b).count() == 5
    assert sorted(r.date.day for r in detect.zero_volume_runs(b).collect()) == [5, 6, 7]
    gaps = detect.unexplained_gaps(b, actions(spark, [("2024-01-06", "split", 2)]))
    assert [r.date.day for r in gaps.collect()] == [7]


def test_calendar_facts():
    days = calendar.session_days(D("2024-07-01"), D("2024-07-08"))
    assert [d.day for d in days] == [1, 2, 3, 5, 8]
    assert not {D("2026-07-03"), D("2024-03-29"), D("2012-10-29")} & set(calendar.session_days(D("2012-01-01"), D("2026-12-31")))


def test_attribution_to_the_second(spark):
    cal = calendar.calendar_map(calendar.sessions(spark, "XNYS", D("2026-06-01"), D("2026-07-31")))
    times = {"2026-06-09 19:29:00": "2026-06-09", "2026-06-09 19:30:00": "2026-06-09", "2026-06-09 19:30:01": "2026-06-10", "2026-06-09 20:00:00": "2026-06-10", "2026-06-13 15:00:00": "2026-06-15", "2026-06-12 21:00:00": "2026-06-15", "2026-07-03 14:00:00": "2026-07-06"}
    rows = spark.createDataFrame([("A", datetime.fromisoformat(t), d) for t, d in times.items()], "ticker string, effective_ts timestamp, want string")
    assert all(str(r.date) == r.want for r in news.trading_day(rows, cal).collect())


def test_sentiment_mean_floor_and_nulls(spark):
    rows = [("a", 0.8, 0.5), ("b", 0.4, -0.25), ("c", 0.1, 1.0), ("d", None, None)]
    df = spark.createDataFrame([("T", D("2024-01-02"), *r) for r in rows], "ticker string, date date, article_id string, relevance double, score_av double")
    r = news.sentiment_daily(df).first()
    assert (round(r.sent_av, 9), r.n_articles, round(r.rel_sum, 9)) == (0.25, 3, 2.2)
    assert news.sentiment_daily(df.where("score_av is null")).first().sent_av is None


def test_feed_rows(spark):
    t = "array<struct<ticker:string,relevance_score:string,ticker_sentiment_score:string>>"
    rows = [("x", "http://a", "20240102T030405", [("aapl", "0.85", "0.42"), ("", "bad", "0.1")]), ("y", "http://b", "20240102T030405", []), ("z", "", "20240102T030405", []), ("w", "http://c", "never", [])]
    feed = spark.createDataFrame(rows, f"title string, url string, time_published string, ticker_sentiment {t}").withColumns({"summary": F.lit("s"), "source": F.lit("s"), "overall_sentiment_score": F.lit(0.1)})
    got = sorted((r.title, r.ticker or "", r.relevance or 0) for r in news.parse_feed(feed, "p").collect())
    assert got == [("x", "", 0), ("x", "AAPL", 0.85), ("y", "", 0)]


def test_perfect_and_inverted_foresight(spark):
    rows = [(f"T{i}", D("2024-01-02"), float(i), float(i * i)) for i in range(6)]
    p = spark.createDataFrame(rows, "ticker string, date date, s double, r double")
    assert research.daily_ic(p, "s", "r").first().ic == pytest.approx(1)
    assert research.daily_ic(p.withColumn("s", -F.col("s")), "s", "r").first().ic == pytest.approx(-1)
    assert research.daily_ic(p.withColumn("s", F.lit(1.0)), "s", "r").count() == 0


def test_event_study_car(spark):
    frames = [bars(spark, [100] * 8 + ([105] * 7 if t == "F" else [100] * 7), t) for t in "ABCDEF"]
    events = spark.createDataFrame([("F", D("2024-01-08"), 1)], "ticker string, date date, sign int")
    car = {r.offset: r.car for r in research.event_study(research.union_all(frames), events, 5, 5).collect()}
    assert car[1] == pytest.approx(0.05 - 0.05 / 6)


def test_validation_and_quarantine(spark):
    df = spark.createDataFrame([("A", D("2024-01-01"), 1.0, 2.0, 1.0, 1.0, 5), ("A", D("2024-01-02"), 1.0, 0.5, 1.0, -5.0, 5), ("A", D("2024-01-03"), 1.0, 2.0, 1.0, 1.0, None)], "ticker string, date date, open double, high double, low double, close double, volume long")
    good, cases = tables.split_valid(tables.validated(df, tables.OHLCV, ["ticker", "date"], ["volume"]))
    assert good.count() == 1 and {r.check for r in cases.collect()} >= {"close_positive", "high_ge_low", "not_null_volume"}


def test_reconcile_bands(spark):
    a, b = bars(spark, [100, 100, 100, 100]), bars(spark, [100, 105, 100.2])
    got = {r.date.day: r.classification for r in tables.reconcile(a, b, ["close", "volume"]).collect()}
    assert got == {2: "discrepancy", 3: "within_tolerance", 4: "missing_in_b"}


def test_history_merge_same_day_change_overwrites(spark):
    h = spark.createDataFrame([("A", "x", D("2024-01-01"), None), ("B", "x", D("2023-01-01"), None)], "ticker string, sector string, effective_from date, effective_to date")
    inc = spark.createDataFrame([("A", "y"), ("B", "z"), ("C", "w")], "ticker string, sector string")
    got = sorted((r.ticker, r.sector, str(r.effective_from), str(r.effective_to)) for r in tables.history_merge(h, inc, "ticker", ["sector"], "2024-01-01").collect())
    assert got == [("A", "y", "2024-01-01", "None"), ("B", "x", "2023-01-01", "2024-01-01"), ("B", "z", "2024-01-01", "None"), ("C", "w", "2024-01-01", "None")]


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("1", "a", "2020"), ("n/a", "2", "x"), ("3.5", "b", "2021")], "cap string, text string, ipoDate string")
    assert dict(tables.coerce_numeric(df).dtypes) == {"cap": "double", "text": "string", "ipoDate": "string"}


def test_latest_wins_is_total(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), (None, 1, "n"), (None, 3, "m")], "k string, t int, v string")
    assert sorted(r.v for r in dedupe.latest_wins(df, ["k"], "t", ["v"]).collect()) == ["c", "m"]


def test_factors_beyond_what_volumes_hold(spark):
    """A hundred splits of one ticker: the volume that no 64-bit number holds is null, nothing fails."""
    days = [date(2000, 1, 1) + timedelta(30 * i) for i in range(100)]
    b = spark.createDataFrame([("A", d, 10.0, 1000) for d in days], "ticker string, date date, close double, volume long")
    a = spark.createDataFrame([("A", d + timedelta(1), "split", 3.0) for d in days], "ticker string, ex_date date, action_type string, value double")
    got = {r.date: (r.close, r.volume, r.close_raw) for r in adjust.adjusted(b, a).collect()}
    assert got[days[0]][1] is None and got[days[-1]] == (pytest.approx(10 / 3), 3000, 10.0)
    joined = {r.date: (r.close, r.volume, r.close_raw) for r in adjust.adjusted_view(b, adjust.adjustment_factors(b, a)).collect()}
    assert joined == got and adjust.as_traded(b, a).where("volume is null").count() == 0


def test_detectors_share_one_exchange(spark):
    b = bars(spark, [10.0 + i % 7 for i in range(80)])
    a = spark.createDataFrame([], "ticker string, ex_date date, action_type string, value double")
    s = spark.createDataFrame([], "calendar string, session date")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(ticker")
    alone = [detect.mad_outliers(b), detect.stale_prices(b), detect.zero_volume_runs(b), detect.unexplained_gaps(b, a), detect.missing_sessions(b, s)]
    assert [exchanges(df) for df in alone[:3]] == [1, 1, 1]
    assert exchanges(detect.battery(b, a, s)) == exchanges(alone[3]) + exchanges(alone[4])


def test_repeated_keys_in_slices_as_in_place(spark):
    rows = [("hot", i) for i in range(300)] + [(None, 1), (None, 2), ("a", 1), ("b", 1), ("b", -1), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    found = [sorted((str(r.k), str(r.v), ",".join(r.failed)) for r in tables.validated(df, {"positive": "v > 0"}, ["k"], ["k"], slices).collect()) for slices in (0, 1, 4, 16)]
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) == len(rows)
    by_key = {(k, v): f for k, v, f in found[0]}
    assert by_key["hot", "5"] == "unique_key" and by_key["None", "1"] == "not_null_k,unique_key" and by_key["b", "-1"] == "positive,unique_key" and by_key["a", "1"] == "" and by_key["c", "None"] == ""


def test_repeated_keys_of_an_empty_table(spark):
    assert tables.validated(spark.createDataFrame([], "k string, v int"), {}, ["k"]).collect() == []
