import math
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cross_section, detect

DAY = date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, close double, volume long")


@pytest.mark.parametrize("window", [2, 5, 8])
@pytest.mark.parametrize("batch", [3, 1000])
def test_sliding_medians_against_each_window(spark, window, batch):
    r = random.Random(window * batch)
    rows = []
    for ticker, n in (("A", 40), ("B", 1), ("C", window + 1), ("D", window + 2), (None, 30)):
        closes = [None if r.random() < 0.04 else r.choice([0.0, -1.0]) if r.random() < 0.02 else round(50 + r.random() * r.choice([0, 9]), 2) for _ in range(n)]
        rows += [(ticker, DAY + timedelta(i), c, i) for i, c in enumerate(closes)]
    wanted = {}
    for ticker in {t for t, *_ in rows}:
        own = [x for x in rows if x[0] == ticker]
        logs = [math.log(c) if c is not None and c > 0 else None for _, _, c, _ in own]
        returns = [None] + [b - a if a is not None and b is not None else None for a, b in zip(logs[:-1], logs[1:], strict=True)]
        for i, (_, day, _, _) in enumerate(own):
            past = returns[max(0, i - window) : i]
            med = mad = None
            if i >= window and None not in past:
                med = statistics.median(past)
                mad = statistics.median(abs(x - med) for x in past) or None
            wanted[ticker, day] = (returns[i], med, mad)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        found = detect.robust_scores(frame(spark, rows), window).collect()
        same = detect.measured(frame(spark, rows), window).collect()
    finally:
        spark.conf.set(key, before)
    close = lambda a, b: a == b or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-13)
    for got in (found, same):
        assert len(got) == len(rows)
        assert [(x.ticker, x.date, (x.r, x.med, x.mad), wanted[x.ticker, x.date]) for x in got if not all(map(close, (x.r, x.med, x.mad), wanted[x.ticker, x.date]))] == []


def test_gaps_are_the_sessions_without_a_bar(spark):
    r = random.Random(3)
    sessions = [(c, DAY + timedelta(i)) for c in ("X", "Y") for i in range(60) if r.random() < 0.7]
    rows = [(t, DAY + timedelta(i - 10), 1.0, 1) for t in "ABC" for i in sorted(r.sample(range(90), 25))] + [("A", DAY, 1.0, 1)] * 2 + [("D", DAY + timedelta(5), 1.0, 1), ("E", None, 1.0, 1)]
    found = sorted((x.ticker, x.date, x.calendar) for x in detect.missing_sessions(frame(spark, rows), spark.createDataFrame(sessions, "calendar string, session date")).select("ticker", "date", F.get_json_object("detail", "$.calendar").alias("calendar")).collect())
    wanted = []
    for t in "ABCD":
        own = {d for x, d, *_ in rows if x == t}
        wanted += [(t, s, c) for c, s in sessions if min(own) < s < max(own) and s not in own]
    assert found == sorted(wanted)
    plan = detect.missing_sessions(frame(spark, rows), spark.createDataFrame(sessions, "calendar string, session date"))._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan


def test_one_date_holds_all_rows(spark):
    """Ranks, quantiles and scores of one date by bins of few values, against a sort."""
    r = random.Random(8)
    values = [float(r.choice([r.gauss(0, 1), round(r.gauss(0, 1), 1), r.gauss(0, 1) ** 5 * 1e6])) for _ in range(1500)] + [0.0, -0.0]
    rows = [(f"T{i}", DAY, v) for i, v in enumerate(values)] + [("N", DAY, None), ("M", DAY, math.nan), ("I", DAY, math.inf), ("alone", DAY + timedelta(1), 4.0), ("p", DAY + timedelta(2), 7.0), ("q", DAY + timedelta(2), 7.0), ("u", None, 1.0), ("v", None, 3.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, score double")
    found = {x.ticker: x for x in cross_section.scores(df, "score", tails=0.05, bin_rows=20).collect()}
    assert len(found) == len(rows)
    ordered, n = sorted(values), len(values)

    def quantile(q):
        at = q * (n - 1)
        lo = ordered[math.floor(at)]
        return lo + (ordered[math.ceil(at)] - lo) * (at - math.floor(at))

    lo, hi = quantile(0.05), quantile(0.95)
    drawn = [min(max(v, lo), hi) for v in values]
    below = {}
    for i, v in enumerate(ordered):
        below.setdefault(v, i)
    m, s, wm, ws = statistics.fmean(values), statistics.stdev(values), statistics.fmean(drawn), statistics.stdev(drawn)
    for i, v in enumerate(values):
        x = found[f"T{i}"]
        assert x.n == n and math.isclose(x.rank_share, below[v] / (n - 1), abs_tol=1e-12)
        assert math.isclose(x.z, (v - m) / s, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(x.z_winsor, (drawn[i] - wm) / ws, rel_tol=1e-9, abs_tol=1e-9)
    assert all(found[t].z is None and found[t].rank_share is None for t in "NMI")
    assert (found["alone"].rank_share, found["alone"].z) == (0.0, None) and (found["p"].rank_share, found["p"].z, found["p"].z_winsor) == (0.0, None, None)
    assert (found["u"].rank_share, found["v"].rank_share) == (0.0, 1.0) and math.isclose(found["v"].z, 0.5**0.5)
