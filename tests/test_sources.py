from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerline.sources import files, synthetic, vendors

HEADER = "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares"


def test_directory(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text(f"{HEADER}\nNA|Some Corp - Common Stock|Q|N|N|100|N|N\n AB |Other|Q|N|D|x|N|N\n\nFile Creation Time: 0102200303:04|||||||\n")
    got = files.read_listing(spark, str(path), files.NASDAQ).orderBy("ticker").collect()
    assert [(r.ticker, r.round_lot_size, r.financial_status) for r in got] == [("AB", None, "D"), ("NA", 100.0, "N")]
    with pytest.raises(ValueError, match="columns have changed"):
        files.read_listing(spark, str(path), files.OTHER)


def test_screener_keeps_a_tickers_first_row(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Symbol,P/E,sector\naa,1,x\nAA,2,y\nbb,,z\n")
    got = {r.ticker: r for r in files.read_screener(spark, str(tmp_path / "s.csv"), "2024-01-02").collect()}
    assert (got["AA"]["P/E"], got["BB"]["P/E"], got["AA"].as_of) == ("1", None, date(2024, 1, 2))
    with pytest.raises(ValueError, match="symbol"):
        files.screener(spark.createDataFrame([("a",)], "name string"), "2024-01-02")


def test_rosters(spark):
    listed = [("A", "Corp", "N", "N", "N"), ("B", "Corp", "V", "N", "N"), ("C", "Corp", "Z", "N", "N"), ("D", "Corp Warrants", "N", "N", "N"), ("E", "Fund", "N", "Y", "N")]
    rows = spark.createDataFrame(listed, "ticker string, security_name string, exchange string, etf string, test_issue string")
    assert {tuple(r) for r in files.rosters(rows).collect()} == {("NYSE", "A"), ("CBOE", "C")}


def test_history(spark):
    rows = spark.createDataFrame([("a", "2024-01-02", 1.0, 2.0, 0.5, 1.5, None, 0.0, 2.0), ("a", "2024-01-03", None, 2.0, 0.5, 1.5, 5.0, 0.3, 0.0)], "ticker string, Date string, Open double, High double, Low double, Close double, Volume double, Dividends double, `Stock Splits` double")
    assert [(r.ticker, r.volume) for r in vendors.history_bars(rows).collect()] == [("A", 0)]
    assert {(r.ex_date.day, r.action_type, r.value) for r in vendors.history_actions(rows).collect()} == {(2, "split", 2.0), (3, "dividend", 0.3)}


def test_json_series(spark):
    day = '{"1. open":"1","2. high":"2","3. low":"0.5","4. close":"1.5","5. volume":"10"}'
    frame = lambda p: spark.createDataFrame([("a", p)], "ticker string, payload string")
    got = vendors.daily_series(frame('{"Time Series (Daily)":{"2024-01-02":' + day + ',"2023-01-02":' + day + "}}"), "2024-01-01", "2024-12-31").collect()
    assert got == [Row(ticker="A", date=date(2024, 1, 2), open=1.0, high=2.0, low=0.5, close=1.5, volume=10)]
    acts = vendors.action_series(frame('{"data":[{"effective_date":"2024-02-01","split_factor":"4"}]}'), "2024-01-01", "2024-12-31").collect()
    assert [(a.action_type, a.value) for a in acts] == [("split", 4.0)]
    with pytest.raises(Exception, match="slow down"):
        vendors.daily_series(frame('{"Note":"slow down"}'), "2024-01-01", "2024-12-31").collect()


def test_items_minutes_bulk_sectors(spark):
    item = "ticker string, content struct<title:string,summary:string,description:string,pubDate:string,canonicalUrl:struct<url:string>,clickThroughUrl:struct<url:string>,provider:struct<displayName:string>>"
    rows = [("a", ("t", "", "d", "2024-01-02T03:04:05Z", None, ("u",), None)), ("a", ("", "", "", "2024-01-02T03:04:05Z", ("u",), None, None)), ("a", ("t", "", "", "soon", ("u",), None, None))]
    assert [(r.summary, r.url, r.source) for r in vendors.news_items(spark.createDataFrame(rows, item)).collect()] == [("d", "u", "")]
    minutes = spark.createDataFrame([("a", 1704205800, 1.0, 1.0, 1.0, 1.0, 5), ("a", 1704205800, 1.0, 1.0, 1.0, 1.0, 5), ("a", 1704205860, 1.0, 1.0, 1.0, 1.0, None)], "ticker string, timestamp long, open double, high double, low double, close double, volume long")
    assert [(r.segment, r.volume) for r in vendors.intraday_bars(minutes).collect()] == [("rth", 5)]
    bulk = spark.createDataFrame([("a", "2024-01-02", "1", "1", "1", "1", "n/a", "0.9"), ("b", "2024-01-02", "x", "1", "1", "1", "3", "1")], "code string, date string, open string, high string, low string, close string, volume string, adjusted_close string")
    assert [(r.ticker, r.volume, r.adjusted_close) for r in vendors.bulk_bars(bulk).collect()] == [("A", 0, 0.9)]
    general = spark.createDataFrame([("a", "", ("NYSE", "Tech", None, None, None)), ("b", "X", None)], "ticker string, exchange string, general struct<Exchange:string,GicSector:string,GicGroup:string,GicIndustry:string,GicSubIndustry:string>")
    out = vendors.sector_rows(general, "2024-01-02")
    assert {(r.ticker, r.exchange, r.gic_sector, r.note) for r in out.collect()} == {("A", "NYSE", "Tech", ""), ("B", "X", "", "gics_missing")}
    assert tuple(vendors.coverage(out, 3, 1).first()) == (3, 1, 1, 1)


def test_payload_hash_limits_and_retries(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    assert vendors.payload_hash(a) == vendors.payload_hash(a.orderBy(F.desc("i"))) != vendors.payload_hash(a.where("i = 1"))
    slept = []
    limiter = vendors.RateLimiter(60, clock=lambda: 100.0, sleep=slept.append)
    for _ in range(3):
        limiter.acquire()
    assert slept == [1.0, 2.0]
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert vendors.retried(flaky, sleep=waits.append) == "ok" and waits == [1.0, 2.0]


def test_synthetic_source_and_events(spark):
    synthetic.register(spark)
    read = lambda names: spark.read.format("synthetic_bars").options(tickers=names, start="2024-01-01", end="2024-03-01", seed="3", batch="1").load()
    both, one = read("a,b"), read("B")
    assert both.where("ticker = 'B'").orderBy("date").collect() == one.orderBy("date").collect()
    assert not both.where("high < greatest(open, close) or low > least(open, close)").count()
    base = {r.date: r for r in one.collect()}
    split = {r.date: r for r in synthetic.with_split(one, "2024-02-01", 4.0).collect()}
    day = date(2024, 2, 1)
    assert split[day].close == pytest.approx(base[day].close / 4) and split[day].volume == base[day].volume * 4
    stale = [r.close for r in synthetic.with_stale_run(one, "2024-02-01", 5).where("date >= '2024-02-01'").orderBy("date").collect()]
    assert len(set(stale[:5])) == 1 and stale[5] != stale[4]
    assert synthetic.with_zero_volume(one, "2024-02-01", 3).where("volume = 0").count() == 3
    assert one.count() - synthetic.without_sessions(one, ["2024-02-01", "2024-02-02"]).count() == 2
    gap = {r.date: r.close for r in synthetic.with_gap(one, "2024-02-01", 0.5).collect()}
    assert gap[day] == pytest.approx(1.5 * base[day].close)
    paid = {r.date: r.close for r in synthetic.with_dividend(one, "2024-02-01", 1.0).collect()}
    before = base[max(d for d in base if d < day)].close
    assert paid[day] == pytest.approx(base[day].close * (1 - 1 / before))


def test_payload_lists_that_are_none(spark):
    one = '[{"timestamp": 1704205800, "gmtoffset": 0, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 7}, {"timestamp": 1704205860, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": null}]'
    texts = [one, one, "[]", "{}", "", None, "no json", '[{"code": null, "date": "2024-01-02", "close": 1}, {"code": "b", "date": "soon", "open": 1, "high": 1, "low": 1, "close": 1}]']
    rows = spark.createDataFrame([("a", "", t) for t in texts], "ticker string, exchange string, payload string")
    assert [(r.ticker, r.close, r.volume, r.segment) for r in vendors.minute_payloads(rows).collect()] == [("A", 1.5, 7, "rth")]
    assert vendors.bulk_payloads(rows).count() == 0
    day = spark.createDataFrame([('[{"code": "b", "exchange_short_name": "US", "date": "2024-01-02", "open": 1, "high": 2, "low": 1, "close": 1.5, "adjusted_close": 1.4, "volume": 3}]',)], "payload string")
    assert [(r.ticker, str(r.date), r.adjusted_close, r.volume) for r in vendors.bulk_payloads(day).collect()] == [("B", "2024-01-02", 1.4, 3)]
    assert {r.note for r in vendors.general_payloads(rows, "2024-01-01").collect()} == {"gics_missing"}
