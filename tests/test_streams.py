import json
import threading
import time
from datetime import date, datetime, timedelta
from urllib.parse import parse_qs, urlparse

import pytest

from ledgerline.functions import calendar
from ledgerline.plans.jobs import Lake
from ledgerline.sources import store, transports
from ledgerline.streaming import first_capture

SCHEMA = "k string, at timestamp, v int"


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), calendar.sessions(spark, "XNYS", date(2024, 1, 2), date(2024, 3, 28)))


def t(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def test_first_captures_stay_over_runs(spark, tmp_path):
    raw, table, state = (str(tmp_path / x) for x in ("raw", "t", "c"))
    drops = [[("a", t(5), 1), ("a", t(3), 2), ("b", t(1), 3), (None, t(0), 9)], [("a", t(0), 4), ("c", None, 5), ("c", t(9), 6)], [("b", t(0), 7), ("c", t(0), 8)]]
    kept = {}
    for n, drop in enumerate(drops):
        spark.createDataFrame(drop, SCHEMA).write.parquet(f"{raw}/{n}")
        done = first_capture.promote_first(spark, raw, SCHEMA, table, state, ["k"], "at")
        # a file that holds a null key alone isn't read, as the filter reaches the scan
        assert [p["rows_passed"] for p in done if p["rows_read"]] == [[2, 1, 0][n]] and sum(p["rows_read"] for p in done) <= len(drop)
        assert done[0]["keys_held"] == [2, 3, 3][n]
        for k in sorted({r[0] for r in drop if r[0]} - set(kept)):
            kept[k] = min((r for r in drop if r[0] == k), key=lambda r: (r[1] is None, r[1] or t(0)))
        assert sorted(map(tuple, store.read_table(spark, table).collect())) == sorted(kept.values())
    assert first_capture.promote_first(spark, raw, SCHEMA, table, state, ["k"], "at") == []
    same = first_capture.captured_first(spark.createDataFrame(drops[0], SCHEMA), ["k"], "at")
    assert sorted(map(tuple, same.collect())) == [("a", t(3), 2), ("b", t(1), 3)]


def test_first_captures_hold_on_as_partitions_change(spark, tmp_path):
    """A session with other shuffle partitions goes on with the state as it is dealt; of a key's rows over many files the earliest passes, ties by their text, and rows stay in the JVM."""
    raw, table, state, got = *(str(tmp_path / x) for x in ("raw", "t", "c")), {}
    kept, name, check = {}, "spark.sql.shuffle.partitions", "spark.sql.streaming.unsupportedOperationCheck"
    before, checked = spark.conf.get(name), spark.conf.get(check)
    try:
        for n, parts in enumerate(("4", "7", "2")):
            spark.conf.set(name, parts)
            drop = [(f"k{i % (100 + 50 * n)}", None if i % 11 == 0 else t(i * 7919 % 37 + 10 * (2 - n)), i * 31 % 1000) for i in range(2000)]
            spark.createDataFrame(drop, SCHEMA).repartition(13).write.parquet(f"{raw}/{n}")

            def put(batch, number):
                assert batch.rdd.getNumPartitions() == 4  # as the first run dealt the state
                for r in batch.collect():
                    assert r.k not in got
                    got[r.k] = tuple(r)

            first_capture.promote_first(spark, raw, SCHEMA, table, state, ["k"], "at", put=put)
            assert (spark.conf.get(name), spark.conf.get(check)) == (parts, checked)
            assert first_capture._dealt(spark, state) == {name: "4"}
            for k in {r[0] for r in drop} - set(kept):
                kept[k] = min((r for r in drop if r[0] == k), key=lambda r: (r[1] is None, r[1] or t(0), str(r[2])))
            assert got == kept and len(kept) == 100 + 50 * n
    finally:
        spark.conf.set(name, before)
    plan = first_capture.first_captures(spark.readStream.schema(SCHEMA).parquet(f"{raw}/0"), ["k"], "at")._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "Python" not in plan and "TransformWithState" not in plan


def bars(spark, rows):
    return spark.createDataFrame([(k, date(2024, 1, d), c, c + 1, c - 1, c, 10, t(m)) for k, d, c, m in rows], "ticker string, date date, open double, high double, low double, close double, volume long, ingested_at timestamp")


def test_a_second_run_reads_the_second_drop_alone(spark, lake):
    store.write_raw(bars(spark, [("AA", 2, 5.0, 0), ("AA", 3, 6.0, 0)]), lake.root, "p", "ohlcv_daily", "r1")
    first = lake.curate("ohlcv_daily")
    assert (first["rows_read"], first["batches"]) == (2, 1)
    assert lake.curate("ohlcv_daily") == {"files": 0, "rows_read": 0, "batches": 0}
    store.write_raw(bars(spark, [("AA", 3, 7.0, 5), ("BB", 3, 8.0, 5), ("BB", 4, 8.0, 5)]), lake.root, "p", "ohlcv_daily", "r2")
    store.write_raw(bars(spark, [("CC", 3, 9.0, 5)]), lake.root, "q", "ohlcv_daily", "r3")
    assert lake.curate("ohlcv_daily", "p")["rows_read"] == 3
    assert [tuple(r) for r in lake.promotions().orderBy("batch").select("provider", "run_ids", "rows_read").collect()] == [("p", ["r1"], 2), ("p", ["r2"], 3)]
    assert sorted((r.ticker, r.date.day, r.close, r.source) for r in lake.table("ohlcv_daily").collect()) == [("AA", 2, 5.0, "p"), ("AA", 3, 7.0, "p"), ("BB", 3, 8.0, "p"), ("BB", 4, 8.0, "p")]
    assert lake.curate("ohlcv_daily")["rows_read"] == 1 and lake.table("ohlcv_daily").count() == 5


def test_a_run_that_fails_goes_on_with_its_batch(spark, lake, monkeypatch):
    for n in range(3):
        store.write_raw(bars(spark, [("AA", 2 + n, 5.0, 0)]).coalesce(1), lake.root, "p", "ohlcv_daily", f"r{n}")
    whole, calls = lake.curate_bars, []

    def failing(raw, run_id):
        calls.append(run_id)
        if len(calls) == 2:
            raise RuntimeError("torn")
        return whole(raw, run_id)

    monkeypatch.setattr(lake, "curate_bars", failing)
    with pytest.raises(Exception, match="torn"):
        lake.curate("ohlcv_daily", files=1)
    assert lake.table("ohlcv_daily").count() == 1 and lake.promotions().count() == 1
    assert lake.curate("ohlcv_daily", files=1) == {"files": 2, "rows_read": 2, "batches": 2}
    assert lake.table("ohlcv_daily").count() == 3 and calls[1] == calls[2]


def test_news_tables_rewrite_only_the_years_that_come_in(spark, lake):
    schema = "article_id string, published_at timestamp, ingested_at timestamp, source string, provider string, title string, summary string, url string, overall_sentiment_score double, ticker string, relevance double, score_av double"
    rows = lambda *ids: spark.createDataFrame([(c * 64, datetime(y, 2, 1), datetime(2024, 3, d), "s", "p", x, "", "u", 0.1, "AA", 0.5, 0.4) for c, y, d, x in ids], schema)
    store.write_raw(rows(("a", 2022, 1, "one"), ("b", 2023, 1, "one")), lake.root, "p", "news", "r1")
    lake.curate("news")
    before = {name: store.current(spark, f"{lake.root}/curated/{name}")[1]["parts"] for name in ("news_articles", "news_ticker_sentiment")}
    store.write_raw(rows(("a", 2022, 5, "two"), ("a", 2021, 6, "moved"), ("c", 2023, 5, "two")), lake.root, "p", "news", "r2")
    lake.curate("news")
    for name, parts in before.items():
        now = store.current(spark, f"{lake.root}/curated/{name}")[1]["parts"]
        assert set(now) == {"year=2022", "year=2023"} and now["year=2022"] == parts["year=2022"] and now["year=2023"] != parts["year=2023"]
    assert sorted((r.article_id[0], r.title, r.year) for r in lake.table("news_articles").collect()) == [("a", "one", 2022), ("b", "one", 2023), ("c", "two", 2023)]
    assert [r.run_ids for r in lake.promotions().orderBy("batch").collect()] == [["r1"], ["r2"]]


def pages(days, broken=()):
    """Answers in the vendor's place: articles by day, full pages first."""

    def send(url):
        asked = parse_qs(urlparse(url).query)
        since, day = asked["time_from"][0], asked["time_from"][0][:8]
        if day in broken:
            raise ValueError("quota used up")
        stamps = [f"{day}T{m // 60:02}{m % 60:02}00" for m in range(days.get(day, 0)) if f"{day}T{m // 60:02}{m % 60:02}" >= since][:1000]
        return json.dumps({"feed": [{"title": s, "url": f"http://x/{s}", "time_published": s, "summary": "", "source": "q", "overall_sentiment_score": 0.1, "ticker_sentiment": [{"ticker": "AA", "relevance_score": "0.5", "ticker_sentiment_score": "0.3"}]} for s in stamps]})

    return send


def test_the_news_stream_resumes_at_the_day_that_failed(spark, lake):
    days = {"20240103": 1200, "20240105": 3, "20240106": 2}
    transports.register(spark, pages(days, {"20240105"}))
    got = lake.stream_news("2024-01-06", "2024-01-02")
    assert (got["days"], got["articles"]) == (3, 1200) and "quota used up" in got["error"]
    assert str(lake.status()["watermarks"].first()["newest"]) == "2024-01-04"  # an empty day counts as read
    transports.register(spark, pages(days))
    assert lake.stream_news("2024-01-06", "2024-01-02") == {"days": 2, "articles": 5, "error": None}
    assert lake.stream_news("2024-01-06", "2024-01-02") == {"days": 0, "articles": 0, "error": None}
    assert lake.stream_news("2024-01-07", "2024-01-02") == {"days": 1, "articles": 0, "error": None}
    # the same as one parse of all answers
    lake.curate("news")
    assert lake.table("news_articles").count() == 1205
    assert {r.url for r in lake.table("news_articles").select("url").collect()} == {f"http://x/{d}T{m // 60:02}{m % 60:02}00" for d, n in days.items() for m in range(n)}


def test_a_day_with_too_many_pages_fails(spark, lake):
    transports.register(spark, pages({"20240102": 1300}))
    got = lake.stream_news("2024-01-03", "2024-01-02", pages=1)
    assert got["days"] == 0 and "more pages than allowed on 2024-01-02" in got["error"]


def test_tasks_share_the_vendors_rate(spark, tmp_path):
    """Four partitions, eight requests a second in all."""
    log = str(tmp_path)

    def send(url):
        open(f"{log}/{time.time_ns()}-{threading.get_ident()}", "w").close()
        time.sleep(0.3)  # an answer takes longer than the gap between requests
        return "{}"

    transports.register(spark, send)
    tickers = [f"T{i}" for i in range(32)]
    got = transports.requested(spark, "general", tickers, per_minute=480, batch=4, tasks=4).collect()
    assert sorted(r.ticker for r in got) == sorted(tickers)
    at = sorted(int(p.name.split("-")[0]) / 1e9 for p in tmp_path.iterdir())
    assert len(at) == 32
    # in any second no more than eight, and the four that the partitions begin with
    assert max(sum(1 for b in at if a <= b < a + 1) for a in at) <= 13
    reader = transports.RequestReader({"what": "history", "tickers": "A,B", "spans": json.dumps({"A": ["2024-01-02", "2024-01-03"], "B": ["2024-02-01", "2024-02-01"]})}, send)
    assert [u.split("period1=")[1].split("&interval")[0] for _, u in reader.urls()] == ["1704153600&period2=1704326400", "1706745600&period2=1706832000"]
    assert sum(p.per_minute for p in transports.RequestReader({"what": "general", "tickers": ",".join(tickers), "batch": "4"}, send).partitions()) == pytest.approx(60)


def model():
    """A scorer in a model's place."""
    return lambda texts: [0.75 for _ in texts]


def test_commands_of_news_and_master(spark, lake, tmp_path):
    from ledgerline import cli

    said = []
    run = lambda *argv: cli.run(spark, ["--root", lake.root, *argv], said.append)
    schema = "article_id string, published_at timestamp, ingested_at timestamp, source string, provider string, title string, summary string, url string, overall_sentiment_score double, ticker string, relevance double, score_av double"
    at = datetime(2024, 2, 9, 4)
    store.write_raw(spark.createDataFrame([(c * 64, at, at, "s", "p", "title", "", "u", 0.1, k, 0.5, 0.4) for c, k in (("a", "AA"), ("b", "0700.HK"))], schema), lake.root, "p", "news", "r1")
    run("news", "curate")
    run("news", "score", "--scorer", "tests.test_streams:model", "--revision", "r9")
    run("news", "build")
    assert "'rows_undated': 0" in said[-1]
    assert sorted((r.ticker, str(r.date), r.sent_av, r.sent_finbert) for r in lake.table("sentiment_daily").collect()) == [("0700.HK", "2024-02-09", 0.4, 0.75), ("AA", "2024-02-09", 0.4, 0.75)]
    assert {r.finbert_revision for r in lake.table("news_ticker_sentiment").collect()} == {"r9"}
    for n, sector in enumerate(("Energy", "Utilities")):
        (tmp_path / f"m{n}.csv").write_text(f"ticker,exchange,gic_sector\n aa ,X,{sector}\nBB,X,Health\n")
        run("security-master", str(tmp_path / f"m{n}.csv"), "--as-of", f"2024-0{n + 1}-01")
    assert sorted((r.ticker, r.gic_sector, str(r.effective_from), str(r.effective_to)) for r in lake.table("security_master").collect()) == [("AA", "Energy", "2024-01-01", "2024-02-01"), ("AA", "Utilities", "2024-02-01", "None"), ("BB", "Health", "2024-01-01", "None")]
    with pytest.raises(SystemExit):
        run("news", "score")
