"""Named queries over the driver's tables, with the same in DuckDB's SQL, written on its own terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import adjust, dedupe, detect, news, research, tables
from ledgerline.sources.adapters import FRAMES, frame, with_frames

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def _query(sql: str | None = None, using: tuple[str, ...] = ()):
    """Registers a function (frames..., by name) as a query. using: the domain frames that it gets and that sql may name."""

    def keep(f):
        name = f.__name__
        _queries[name] = lambda spark, sf_dir: f(*(frame(spark, sf_dir, n) for n in using)) if using else f(spark, sf_dir)
        if sql:
            s = sql.strip()
            _oracles[name] = (f"{with_frames(*using)}, {s[5:]}" if s.startswith("WITH ") else f"{with_frames(*using)} {s}") if using else s
        return f

    return keep


def _r(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Rounded columns, in which a negative zero is a zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


_SPLITS = """sp AS (SELECT ticker, value AS ratio, ex_date, row_number() OVER (PARTITION BY ticker, value ORDER BY ex_date) AS rn FROM actions WHERE action_type = 'split'),
fold AS (SELECT ticker, ratio, ex_date, rn, ex_date AS kept, TRUE AS keep FROM sp WHERE rn = 1 UNION ALL
  SELECT s.ticker, s.ratio, s.ex_date, s.rn, CASE WHEN s.ex_date - f.kept > 20 THEN s.ex_date ELSE f.kept END, s.ex_date - f.kept > 20 FROM fold f JOIN sp s ON s.ticker = f.ticker AND s.ratio = f.ratio AND s.rn = f.rn + 1),
splits AS (SELECT ticker, ex_date, ratio FROM fold WHERE keep)"""
_FACTORS = (
    _SPLITS
    + """, divs AS (SELECT a.ticker, a.ex_date, a.value, max_by(b.close, b.date) AS prev_close FROM actions a LEFT JOIN bars b ON b.ticker = a.ticker AND b.date < a.ex_date WHERE a.action_type = 'dividend' GROUP BY 1, 2, 3),
sf AS (SELECT b.ticker, b.date, coalesce(product(1 / s.ratio), 1) AS split_factor FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.ex_date > b.date GROUP BY 1, 2),
df AS (SELECT b.ticker, b.date, coalesce(product(1 - d.value / d.prev_close), 1) AS div_factor FROM bars b LEFT JOIN divs d ON d.ticker = b.ticker AND d.ex_date > b.date AND d.prev_close IS NOT NULL AND 1 - d.value / d.prev_close > 0 GROUP BY 1, 2)"""
)


@_query(f"WITH {_SPLITS} SELECT ticker, ex_date, ratio FROM splits", ("actions",))
def split_dedup(actions):
    return adjust.dedupe_splits(actions)


@_query(f"WITH {_SPLITS} SELECT b.ticker, b.date, round(coalesce(product(1 / s.ratio), 1), 10) AS factor FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.ex_date > b.date GROUP BY 1, 2", ("bars", "actions"))
def suffix_factor(bars, actions):
    splits = adjust.dedupe_splits(actions).select("ticker", "ex_date", (1 / F.col("ratio")).alias("mult"))
    return _r(adjust.suffix_product(bars, splits, "factor"), 10, "factor")


@_query("SELECT a.ticker, a.ex_date, a.value, max_by(b.close, b.date) AS prev_close FROM actions a LEFT JOIN bars b ON b.ticker = a.ticker AND b.date < a.ex_date WHERE a.action_type = 'dividend' GROUP BY 1, 2, 3", ("bars", "actions"))
def dividend_asof(bars, actions):
    return adjust.dividend_asof(bars, actions)


@_query(f"WITH {_FACTORS} SELECT b.ticker, b.date, round(b.close * split_factor * div_factor + 1e-9, 6) AS close, b.close AS close_raw, CAST(round(b.volume / split_factor) AS BIGINT) AS volume, round(split_factor * div_factor, 10) AS adj_factor FROM bars b JOIN sf USING (ticker, date) JOIN df USING (ticker, date)", ("bars", "actions"))
def adj_close(bars, actions):
    out = adjust.adjusted(bars, actions)
    # prices of few decimals lie on ties, which engines round either way; a nudge beyond them settles it
    return _r(_r(out.withColumn("close", F.col("close") + 1e-9), 6, "close"), 10, "adj_factor")


@_query(f"WITH {_SPLITS}, u AS (SELECT b.ticker, b.date, coalesce(product(s.ratio), 1) AS up FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.ex_date > b.date GROUP BY 1, 2) SELECT b.ticker, b.date, b.close * up AS close, CAST(round(b.volume / up) AS BIGINT) AS volume FROM bars b JOIN u USING (ticker, date)", ("bars", "actions"))
def as_traded(bars, actions):
    return adjust.as_traded(bars, actions)


_MAD = """r AS (SELECT *, ln(close) - ln(lag(close) OVER (PARTITION BY ticker ORDER BY date)) AS r FROM bars),
m AS (SELECT ticker, date, r, CASE WHEN count(r) OVER w = 63 THEN median(r) OVER w END AS med, CASE WHEN count(r) OVER w = 63 THEN nullif(mad(r) OVER w, 0) END AS mad FROM r WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 63 PRECEDING AND 1 PRECEDING)),
outliers AS (SELECT ticker, date, r, 0.6745 * (r - med) / mad AS z FROM m WHERE abs(0.6745 * (r - med) / mad) > 3)"""
_STALE = """p AS (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev FROM rough), i AS (SELECT *, sum(CASE WHEN close = prev THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY date) AS isl FROM p),
n AS (SELECT *, count(*) OVER (PARTITION BY ticker, isl) AS run_length FROM i) SELECT ticker, date, CASE WHEN volume > 0 THEN 'warn' ELSE 'info' END AS severity, run_length FROM n WHERE run_length >= 3"""


def _detail(df: DataFrame, schema: str, *more: str) -> DataFrame:
    """Parsed fields of the flags' JSON."""
    return df.withColumn("d", F.from_json("detail", schema)).select("ticker", "date", *more, "d.*")


@_query(f"WITH {_MAD} SELECT ticker, date, round(r, 6) AS log_return, round(z, 2) AS robust_z FROM outliers", ("bars",))
def mad_outliers(bars):
    return _detail(detect.mad_outliers(bars, 63, 3.0), "log_return double, robust_z double")


def _rough(bars: DataFrame) -> DataFrame:
    """Prices in steps of 250 and volumes in steps of 60, so that runs occur."""
    return bars.select("ticker", "date", (F.floor(F.col("close") / 250) * 250).cast("double").alias("close"), (F.floor(F.col("volume") / 40) * 40).cast("long").alias("volume"))


_ROUGH = "rough AS (SELECT ticker, date, CAST(floor(close / 250) * 250 AS DOUBLE) AS close, CAST(floor(volume / 40) * 40 AS BIGINT) AS volume FROM bars)"


@_query(f"WITH {_ROUGH}, {_STALE}", ("bars",))
def stale_runs(bars):
    return _detail(detect.stale_prices(_rough(bars), 3), "run_length bigint", "severity")


@_query(f"WITH {_ROUGH}, i AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) - row_number() OVER (PARTITION BY ticker, volume = 0 ORDER BY date) AS isl FROM rough), n AS (SELECT *, count(*) OVER (PARTITION BY ticker, volume = 0, isl) AS run_length FROM i) SELECT ticker, date, run_length FROM n WHERE volume = 0 AND run_length >= 3", ("bars",))
def zero_volume_runs(bars):
    return _detail(detect.zero_volume_runs(_rough(bars), 3), "run_length bigint")


@_query("WITH c AS (SELECT *, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ch FROM bars) SELECT ticker, date, round(ch, 6) AS pct_change FROM c WHERE abs(ch) > 0.3 AND NOT EXISTS (SELECT 1 FROM actions a WHERE a.ticker = c.ticker AND a.ex_date = c.date)", ("bars", "actions"))
def unexplained_gaps(bars, actions):
    return _detail(detect.unexplained_gaps(bars, actions), "pct_change double")


_MISSING = "b AS (SELECT ticker, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1), missing AS (SELECT b.ticker, s.session AS date FROM b JOIN sessions s ON s.session BETWEEN b.lo AND b.hi WHERE NOT EXISTS (SELECT 1 FROM bars x WHERE x.ticker = b.ticker AND x.date = s.session))"


@_query(f"WITH {_MISSING} SELECT ticker, date FROM missing", ("bars", "sessions"))
def missing_sessions(bars, sessions):
    return detect.missing_sessions(bars, sessions).select("ticker", "date")


_FLAGS = f"{_MAD}, {_MISSING}, gaps AS (SELECT ticker, date FROM (SELECT *, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ch FROM bars) c WHERE abs(ch) > 0.3 AND NOT EXISTS (SELECT 1 FROM actions a WHERE a.ticker = c.ticker AND a.ex_date = c.date)), stale AS (SELECT ticker, date FROM (SELECT *, count(*) OVER (PARTITION BY ticker, isl) AS n FROM (SELECT *, sum(CASE WHEN close = prev THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY date) AS isl FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS prev FROM bars))) WHERE n >= 5), flags AS (SELECT ticker, date, 'return_outlier_mad' AS flag_type, 'warn' AS severity FROM outliers UNION ALL SELECT ticker, date, 'unexplained_gap', 'error' FROM gaps UNION ALL SELECT ticker, date, 'missing_session', 'warn' FROM missing UNION ALL SELECT ticker, date, 'stale_price', 'warn' FROM stale)"


@_query(f"WITH {_FLAGS} SELECT flag_type, severity, count(*) AS n FROM flags GROUP BY 1, 2", ("bars", "actions", "sessions"))
def flag_summary(bars, actions, sessions):
    return detect.flag_summary(detect.battery(bars, actions, sessions, threshold=3.0))


@_query(f"WITH {_FLAGS} SELECT ticker, count(*) AS n FROM flags GROUP BY 1 ORDER BY n DESC, ticker LIMIT 10", ("bars", "actions", "sessions"))
def ranked_topk(bars, actions, sessions):
    return detect.most_flagged(detect.battery(bars, actions, sessions, threshold=3.0))


@_query(f"WITH {_FLAGS}, k AS (SELECT ticker, date, count(*) AS n_flags, string_agg(DISTINCT flag_type, ',' ORDER BY flag_type) AS flag_types FROM flags GROUP BY 1, 2) SELECT b.ticker, b.date, b.close, b.volume, coalesce(n_flags, 0) AS n_flags, flag_types FROM bars b LEFT JOIN k USING (ticker, date)", ("bars", "actions", "sessions"))
def clean_view(bars, actions, sessions):
    return detect.clean_view(bars, detect.battery(bars, actions, sessions, threshold=3.0))


@_query("SELECT ticker, date, close, volume FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars) WHERE rn <= 260", ("bars",))
def trailing_slice(bars):
    return detect.trailing_slice(bars)


@_query("SELECT ticker, max_by(seq, (started_at, seq)) AS seq, max(started_at) AS started_at FROM manifest GROUP BY ticker", ("manifest",))
def latest_wins(manifest):
    return dedupe.latest_wins(manifest, ["ticker"], "started_at", ["seq"]).select("ticker", "seq", "started_at")


@_query("SELECT ticker, min_by(seq, (started_at, seq)) AS seq, min(started_at) AS started_at FROM manifest GROUP BY ticker", ("manifest",))
def first_wins(manifest):
    return dedupe.first_wins(manifest, ["ticker"], "started_at", ["seq"]).select("ticker", "seq", "started_at")


@_query("WITH inc AS (SELECT ticker, date, close + 1 AS close, volume FROM bars WHERE volume % 3 = 0 UNION ALL SELECT concat(ticker, 'X'), date, close, volume FROM bars WHERE volume % 5 = 0) SELECT ticker, date, close, volume FROM inc UNION ALL SELECT ticker, date, close, volume FROM bars b WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.ticker = b.ticker AND i.date = b.date)", ("bars",))
def upsert_merge(bars):
    from ledgerline.sources import store

    inc = bars.where("volume % 3 = 0").withColumn("close", F.col("close") + 1).unionByName(bars.where("volume % 5 = 0").withColumn("ticker", F.concat("ticker", F.lit("X"))))
    return store.merged(bars, inc, ["ticker", "date"])


_BAD = "bad AS (SELECT ticker, CASE WHEN volume % 50 = 0 THEN NULL ELSE date END AS date, close AS open, close AS low, close AS close, CASE WHEN volume % 7 = 0 THEN close - 1 ELSE close END AS high, CASE WHEN volume % 11 = 0 THEN -volume ELSE volume END AS volume FROM bars)"


@_query(f"WITH {_BAD}, c AS (SELECT *, count(*) OVER (PARTITION BY ticker, date) AS k FROM bad) SELECT chk AS \"check\", count(*) AS n FROM (SELECT unnest([CASE WHEN date IS NULL THEN 'not_null_date' END, CASE WHEN high < low THEN 'high_ge_low' END, CASE WHEN high < open THEN 'high_ge_open' END, CASE WHEN high < close THEN 'high_ge_close' END, CASE WHEN volume < 0 THEN 'volume_nonnegative' END, CASE WHEN high <= 0 THEN 'high_positive' END, CASE WHEN k > 1 THEN 'unique_key' END]) AS chk FROM c) WHERE chk IS NOT NULL GROUP BY 1", ("bars",))
def row_validation(bars):
    bad = bars.select("ticker", F.when(F.col("volume") % 50 != 0, F.col("date")).alias("date"), F.col("close").alias("open"), F.col("close").alias("low"), "close", F.when(F.col("volume") % 7 == 0, F.col("close") - 1).otherwise(F.col("close")).alias("high"), F.when(F.col("volume") % 11 == 0, -F.col("volume")).otherwise(F.col("volume")).alias("volume"))
    _, cases = tables.split_valid(tables.validated(bad, tables.OHLCV, ["ticker", "date"], ["ticker", "date"]))
    return cases.groupBy("check").agg(F.count("*").alias("n"))


_OTHER = "other AS (SELECT ticker, date, CASE WHEN volume % 9 = 0 THEN close * 1.02 WHEN volume % 10 = 0 THEN close * 1.002 ELSE close END AS close, volume FROM bars WHERE volume % 13 <> 0)"
_RECON = f"""{_OTHER}, j AS (SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.date, b.date) AS date, a.close AS ca, b.close AS cb, a.ticker IS NOT NULL AS ina, b.ticker IS NOT NULL AS inb FROM bars a FULL JOIN other b ON a.ticker = b.ticker AND a.date = b.date),
rec AS (SELECT ticker, date, 'close' AS field, ca AS value_a, cb AS value_b, round(abs(ca - cb) / greatest(abs(ca), abs(cb), 1e-12), 9) AS rel_diff, CASE WHEN abs(ca - cb) / greatest(abs(ca), abs(cb), 1e-12) <= 0.005 THEN 'within_tolerance' ELSE 'discrepancy' END AS classification FROM j WHERE ina AND inb AND ca <> cb
UNION ALL SELECT ticker, date, NULL, NULL, NULL, NULL, CASE WHEN NOT inb THEN 'missing_in_b' ELSE 'missing_in_a' END FROM j WHERE NOT ina OR NOT inb)"""


def _reconciled(bars):
    other = bars.where("volume % 13 <> 0").withColumn("close", F.when(F.col("volume") % 9 == 0, F.col("close") * 1.02).when(F.col("volume") % 10 == 0, F.col("close") * 1.002).otherwise(F.col("close")))
    return _r(tables.reconcile(bars, other, ["close", "volume"]), 9, "rel_diff")


@_query(f"WITH {_RECON} SELECT * FROM rec", ("bars",))
def reconcile_rows(bars):
    return _reconciled(bars)


@_query(f"WITH {_RECON} SELECT ticker, classification, count(*) AS n FROM rec GROUP BY 1, 2", ("bars",))
def reconcile_summary(bars):
    return _reconciled(bars).groupBy("ticker", "classification").agg(F.count("*").alias("n"))


@_query("SELECT DISTINCT ticker FROM membership WHERE index_name = 'IDX' AND effective_from <= DATE '2001-06-01' AND (effective_to IS NULL OR DATE '2001-06-01' < effective_to)", ("membership",))
def members_as_of(membership):
    return tables.members_as_of(membership, "2001-06-01", "IDX")


@_query("WITH c AS (SELECT DISTINCT ticker FROM membership WHERE effective_to IS NULL), t AS (SELECT DISTINCT ticker FROM snapshot) SELECT coalesce(c.ticker, t.ticker) AS ticker, CASE WHEN c.ticker IS NULL THEN 'add' WHEN t.ticker IS NULL THEN 'close' ELSE 'keep' END AS change FROM c FULL JOIN t ON c.ticker = t.ticker", ("membership", "snapshot"))
def membership_diff(membership, snapshot):
    return tables.membership_diff(membership.where("effective_to is null"), snapshot)


@_query("""WITH j AS (SELECT m.*, s.ticker IS NOT NULL AS seen, m.effective_to IS NULL AND s.ticker IS NOT NULL AND (m.sector IS DISTINCT FROM s.sector OR m.exchange IS DISTINCT FROM s.exchange) AS changed FROM master m LEFT JOIN snapshot s ON s.ticker = m.ticker)
SELECT ticker, sector, exchange, effective_from, CASE WHEN changed THEN DATE '2024-01-01' ELSE effective_to END AS effective_to FROM j UNION ALL
SELECT s.ticker, s.sector, s.exchange, DATE '2024-01-01', NULL FROM snapshot s WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.ticker = s.ticker AND j.effective_to IS NULL AND NOT j.changed)""", ("master", "snapshot"))
def scd2_changes(master, snapshot):
    return tables.history_merge(master, snapshot, "ticker", ["sector", "exchange"], "2024-01-01")


@_query("SELECT * FROM directory WHERE test_issue = 'N' AND etf = 'N' AND financial_status IN ('N', 'D') AND NOT regexp_matches(lower(security_name), 'warrant|right|unit|preferred|notes|debenture|bond') AND regexp_full_match(ticker, '[A-Z]{1,5}')", ("directory",))
def common_stock_filter(directory):
    return tables.common_stocks(directory)


@_query("SELECT ticker, CASE WHEN p_partkey % 21 = 0 THEN NULL ELSE CAST(p_partkey AS DOUBLE) END AS num, CASE WHEN p_partkey % 2 = 0 THEN 'x' ELSE CAST(p_partkey AS VARCHAR) END AS mixed FROM directory", ("directory",))
def numeric_coercion(directory):
    raw = directory.select("ticker", F.when(F.col("p_partkey") % 21 == 0, "n/a").otherwise(F.col("p_partkey").cast("string")).alias("num"), F.when(F.col("p_partkey") % 2 == 0, "x").otherwise(F.col("p_partkey").cast("string")).alias("mixed"))
    return tables.coerce_numeric(raw, keep=("ticker",))


@_query("WITH w AS (SELECT *, coalesce(relevance, 1.0) AS w FROM news WHERE coalesce(relevance, 1.0) >= 0.25) SELECT ticker, date, round(sum(CASE WHEN score_av IS NOT NULL THEN score_av * w END) / sum(CASE WHEN score_av IS NOT NULL THEN w END), 8) AS sent_av, count(DISTINCT article_id) AS n_articles, round(sum(w), 8) AS rel_sum, round(ln(1 + count(DISTINCT article_id)), 8) AS log_n_articles FROM w GROUP BY 1, 2", ("news",))
def sentiment_daily(news_):
    return _r(news.sentiment_daily(news_), 8, "sent_av", "rel_sum", "log_n_articles")


@_query("WITH s AS (SELECT b.ticker, b.date, f.score, f.date AS obs FROM (SELECT DISTINCT ticker, date FROM bars) b LEFT JOIN factor f USING (ticker, date)), w AS (SELECT ticker, date, last_value(score IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS last_score, date - max(obs) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) AS days_since FROM s) SELECT ticker, date, last_score, CAST(days_since AS INTEGER) AS days_since, round(last_score * exp(-days_since / 5.0), 9) + 0.0::DOUBLE AS decayed FROM w", ("bars", "factor"))
def sentiment_decayed(bars, factor):
    return _r(news.decayed(bars, factor, "score"), 9, "decayed")


@_query("SELECT *, round(lead(close, 1) OVER w / close - 1, 8) AS fwd_1, round(lead(close, 5) OVER w / close - 1, 8) AS fwd_5, round(lead(close, 20) OVER w / close - 1, 8) AS fwd_20 FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)", ("bars",))
def forward_returns(bars):
    return _r(research.forward_returns(bars), 8, "fwd_1", "fwd_5", "fwd_20")


_IC = """h AS (SELECT ticker, date, hz AS horizon, CASE hz WHEN 1 THEN lead(close, 1) OVER w WHEN 5 THEN lead(close, 5) OVER w ELSE lead(close, 20) OVER w END / close - 1 AS ret FROM bars, (SELECT unnest([1, 5, 20]) AS hz) WINDOW w AS (PARTITION BY ticker, hz ORDER BY date)),
p AS (SELECT h.horizon, h.date, f.score, h.ret FROM h JOIN factor f USING (ticker, date) WHERE h.ret IS NOT NULL AND f.score IS NOT NULL),
k AS (SELECT horizon, date, rank() OVER (PARTITION BY horizon, date ORDER BY score) + (count(*) OVER (PARTITION BY horizon, date, score) - 1) / 2.0 AS rs, rank() OVER (PARTITION BY horizon, date ORDER BY ret) + (count(*) OVER (PARTITION BY horizon, date, ret) - 1) / 2.0 AS rr FROM p),
ic AS (SELECT horizon, date, corr(rs, rr) AS ic, count(*) AS n FROM k GROUP BY 1, 2 HAVING count(*) >= 5 AND min(rs) < max(rs) AND min(rr) < max(rr)),
su AS (SELECT horizon, count(ic) AS n_days, avg(ic) AS mean_ic, stddev_samp(ic) AS std_ic, avg((round(ic, 9) > 0)::INT) AS hit_rate FROM ic GROUP BY 1)"""


def _panel(bars, factor):
    return factor.join(research.forward_returns(bars), ["ticker", "date"])


@_query(f"WITH {_IC} SELECT date, round(ic, 6) + 0.0::DOUBLE AS ic, n FROM ic WHERE horizon = 1", ("bars", "factor"))
def daily_ic(bars, factor):
    return _r(research.daily_ic(_panel(bars, factor), "score", "fwd_1"), 6, "ic")


_SUMMARY = "n_days, round(mean_ic, 6) AS mean_ic, round(std_ic, 6) AS std_ic, round(hit_rate, 6) AS hit_rate, round(mean_ic / std_ic, 6) AS icir, round(mean_ic / std_ic * sqrt(n_days), 6) AS t_stat FROM su"


@_query(f"WITH {_IC} SELECT {_SUMMARY} WHERE horizon = 1", ("bars", "factor"))
def ic_summary(bars, factor):
    return _r(research.ic_summary(research.daily_ic(_panel(bars, factor), "score", "fwd_1")), 6, "mean_ic", "std_ic", "hit_rate", "icir", "t_stat")


@_query(f"WITH {_IC} SELECT CAST(horizon AS INTEGER) AS horizon, {_SUMMARY}", ("bars", "factor"))
def ic_decay(bars, factor):
    return _r(research.ic_decay(factor, bars, "score"), 6, "mean_ic", "std_ic", "hit_rate", "icir", "t_stat")


@_query("SELECT ticker, date, CAST(sign(score) AS INTEGER) AS sign FROM factor WHERE abs(score) >= 0.9 AND n_articles >= 1 AND score <> 0", ("factor",))
def find_events(factor):
    return research.find_events(factor, "score", 0.9)


@_query("""WITH r AS (SELECT ticker, date, close / lag(close) OVER w - 1 AS ret, row_number() OVER w AS i FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
a AS (SELECT ticker, date, i, ret - avg(ret) OVER (PARTITION BY date) AS ar, max(i) OVER (PARTITION BY ticker) AS last FROM r),
e AS (SELECT a.ticker, a.i, CAST(sign(f.score) AS INTEGER) AS sign FROM factor f JOIN a USING (ticker, date) WHERE abs(f.score) >= 0.9 AND a.i > 5 AND a.i + 20 <= a.last),
m AS (SELECT e.sign, CAST(a.i - e.i AS INTEGER) AS "offset", count(*) AS n_events, avg(a.ar) AS mean_ar FROM e JOIN a ON a.ticker = e.ticker AND a.i BETWEEN e.i - 5 AND e.i + 20 GROUP BY 1, 2)
SELECT sign, "offset", n_events, round(mean_ar, 6) AS mean_ar, round(sum(mean_ar) OVER (PARTITION BY sign ORDER BY "offset"), 6) AS car FROM m""", ("bars", "factor"))
def event_study_car(bars, factor):
    return _r(research.event_study(bars, research.find_events(factor, "score", 0.9)), 6, "mean_ar", "car")


@_query("""WITH b AS (SELECT *, close - lag(close) OVER w AS d, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars WHERE ticker IN ('S1', 'S2', 'S3', 'S4') WINDOW w AS (PARTITION BY ticker ORDER BY date)),
x AS (SELECT ticker, max(CASE WHEN rn = 1 THEN date END) AS date, max(CASE WHEN rn = 1 THEN close END) AS close, max(CASE WHEN rn = 1 THEN close END) / max(CASE WHEN rn = 6 THEN close END) - 1 AS ret_5, max(CASE WHEN rn = 1 THEN close END) / max(CASE WHEN rn = 21 THEN close END) - 1 AS ret_20,
max(CASE WHEN rn = 1 THEN close END) / avg(CASE WHEN rn <= 20 THEN close END) - 1 AS dist_sma_20, max(CASE WHEN rn = 1 THEN close END) / avg(CASE WHEN rn <= 50 THEN close END) - 1 AS dist_sma_50,
100 - 100 / (1 + avg(CASE WHEN rn <= 14 THEN greatest(d, 0) END) / avg(CASE WHEN rn <= 14 THEN greatest(-d, 0) END)) AS rsi_14 FROM b GROUP BY 1)
SELECT ticker, date, close, round(ret_5, 8) AS ret_5, round(ret_20, 8) AS ret_20, round(dist_sma_20, 8) AS dist_sma_20, round(dist_sma_50, 8) AS dist_sma_50, round(rsi_14, 6) AS rsi_14, round(ret_20 - (SELECT median(ret_20) FROM x), 8) AS rel_strength FROM x""", ("bars",))
def basket_metrics(bars):
    return _r(_r(research.basket_metrics(bars, ["S1", "S2", "S3", "S4"]), 8, "ret_5", "ret_20", "dist_sma_20", "dist_sma_50", "rel_strength"), 6, "rsi_14")


@_query("WITH b AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars), x AS (SELECT ticker, max(CASE WHEN rn = 1 THEN date END) AS date, max(CASE WHEN rn = 1 THEN close END) AS close, max(CASE WHEN rn = 22 THEN close END) AS c21, max(CASE WHEN rn = 64 THEN close END) AS c63, max(CASE WHEN rn = 127 THEN close END) AS c126, max(CASE WHEN rn = 253 THEN close END) AS c252, max(CASE WHEN rn <= 252 THEN close END) AS hi FROM b GROUP BY 1) SELECT ticker, date, close, round(close / c21 - 1, 8) AS mom_21, round(close / c63 - 1, 8) AS mom_63, round(close / c126 - 1, 8) AS mom_126, round(close / c252 - 1, 8) AS mom_252, round(close / hi - 1, 8) AS dist_high FROM x", ("bars",))
def momentum(bars):
    return _r(research.momentum(bars), 8, "mom_21", "mom_63", "mom_126", "mom_252", "dist_high")


@_query("SELECT run_id, provider, dataset, min(started_at) AS started_at, count(*) AS n, sum((status = 'ok')::INT)::BIGINT AS ok, sum((status = 'failed')::INT)::BIGINT AS failed, sum(rows_fetched)::BIGINT AS rows_fetched FROM manifest GROUP BY 1, 2, 3 ORDER BY started_at DESC, run_id, provider, dataset LIMIT 10", ("manifest",))
def run_rollup(manifest):
    return tables.run_rollup(manifest)


@_query("SELECT provider, dataset, ticker, max_by(started_at, (seq, started_at)) AS high_water_date FROM manifest GROUP BY 1, 2, 3", ("manifest",))
def watermark_latest(manifest):
    return tables.watermark_latest(manifest.select("provider", "dataset", "ticker", F.col("started_at").alias("high_water_date"), F.col("seq").alias("updated_at")))


@_query("SELECT sector, count(*) AS n, count(*) / (SELECT count(*) FROM snapshot) AS share FROM snapshot GROUP BY 1", ("snapshot",))
def sector_concentration(snapshot):
    return tables.sector_concentration(snapshot)


@_query("SELECT DISTINCT ticker FROM snapshot WHERE ticker NOT IN (SELECT ticker FROM master UNION SELECT ticker FROM membership WHERE effective_to IS NULL)", ("snapshot", "master", "membership"))
def ghost_tickers(snapshot, master, membership):
    return tables.ghosts(snapshot, master, membership.where("effective_to is null"))


@_query("SELECT seg AS segment, count(*) AS n FROM (SELECT CASE WHEN m >= 570 AND m < 960 THEN 'rth' ELSE 'ext' END AS seg FROM (SELECT extract(hour FROM l) * 60 + extract(minute FROM l) AS m FROM (SELECT (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS l FROM events))) GROUP BY 1")
def intraday_segment(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"))
    return ev.select(news.segment("ts").alias("segment")).groupBy("segment").agg(F.count("*").alias("n"))


@_query("SELECT sha256(url) AS article_id, page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages WHERE url IS NOT NULL AND url <> ''")
def article_ids(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("url is not null and url <> ''")
    return pages.select(F.sha2("url", 256).alias("article_id"), "page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))


@_query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY 1, 2")
def feed_fields(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.groupBy("event_type", (F.from_json("props", "k bigint")["k"] % 10).alias("k")).agg(F.count("*").alias("n"))


#: Closures on weekdays from 2023-12-25 on as the exchanges published them, written out here apart from the rules that the operator follows.
_CLOSURES = {"XNYS": ["2023-12-25", "2024-01-01", "2024-01-15", "2024-02-19"], "XHKG": ["2023-12-25", "2023-12-26", "2024-01-01", "2024-02-12", "2024-02-13"], "XKRX": ["2023-12-25", "2023-12-29", "2024-01-01", "2024-02-09", "2024-02-12", "2024-03-01"]}
_TRADING = f"""m AS (SELECT * FROM (VALUES ('A', 'XNYS', 'America/New_York', TIME '15:30:00'), ('b.hk', 'XHKG', 'Asia/Hong_Kong', TIME '15:30:00'), ('C.KQ', 'XKRX', 'Asia/Seoul', TIME '15:00:00')) t(ticker, cal, zone, cut)),
closed AS (SELECT * FROM (VALUES {", ".join(f"('{c}', DATE '{d}')" for c, days in _CLOSURES.items() for d in days)}) t(cal, d)),
s AS (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-03-15', INTERVAL 1 DAY))::DATE AS d),
ses AS (SELECT cal, s.d, x.d IS NULL AND dayofweek(s.d) BETWEEN 1 AND 5 AS open FROM (SELECT cal FROM m) CROSS JOIN s LEFT JOIN closed x USING (cal, d)),
nxt AS (SELECT cal, d, open, min(CASE WHEN open THEN d END) OVER (PARTITION BY cal ORDER BY d ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM ses),
l AS (SELECT event_id, m.ticker, m.cal, m.cut, (ts AT TIME ZONE 'UTC') AT TIME ZONE m.zone AS t FROM events JOIN m ON m.ticker = ['A', 'b.hk', 'C.KQ'][event_id % 3 + 1])
SELECT event_id, ticker, CASE WHEN open AND date_trunc('second', t)::TIME <= cut THEN d ELSE later END AS date FROM l LEFT JOIN nxt ON nxt.cal = l.cal AND nxt.d = l.t::DATE"""


@_query("WITH " + _TRADING)
def trading_day(spark, sf_dir):
    from datetime import date

    from ledgerline.functions import calendar

    ticker = F.when(F.col("event_id") % 3 == 0, "A").when(F.col("event_id") % 3 == 1, "b.hk").otherwise("C.KQ")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", ticker.alias("ticker"), F.col("ts").cast("timestamp").alias("effective_ts"))
    markets = calendar.sessions(spark, ["XNYS", "XHKG", "XKRX"], date(2023, 12, 25), date(2024, 3, 15))
    # the map begins and ends with a session; these days lie inside for all three
    return news.trading_day(ev, calendar.calendar_map(markets)).select("event_id", "ticker", "date")


_LISTED = "SELECT upper(substr(replace(p_name, ' ', ''), 1, 3 + CAST(p_partkey % 4 AS INT))) AS ticker, trim(p_name) AS security_name, CASE WHEN p_partkey % 3 = 0 THEN 'N' WHEN p_partkey % 3 = 1 THEN 'A' ELSE 'V' END AS exchange, p_brand AS cqs_symbol, 'N' AS etf, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS round_lot_size, 'N' AS test_issue, CAST(p_partkey AS VARCHAR) AS nasdaq_symbol FROM part"


def _listed(spark, sf_dir):
    """The parts as lines of a directory file, with a header, a blank line and a footer."""
    from ledgerline.sources import files

    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    code = F.when(F.col("p_partkey") % 3 == 0, "N").when(F.col("p_partkey") % 3 == 1, "A").otherwise("V")
    lot = F.when(F.col("p_partkey") % 17 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    ticker = F.upper(F.substr(F.replace("p_name", F.lit(" "), F.lit("")), F.lit(1), (F.col("p_partkey") % 4 + 3).cast("int")))
    lines = part.select(F.concat_ws("|", ticker, F.concat(F.lit("  "), "p_name", F.lit(" ")), code, "p_brand", F.lit("N"), lot, F.lit("N"), F.col("p_partkey").cast("string")).alias("value"))
    header = "|".join(files.OTHER)
    return files.listing(lines.union(spark.createDataFrame([(header,), ("",), ("File Creation Time: 01012024|||||||",)], "value string")), header, files.OTHER)


@_query(_LISTED)
def listing_parse(spark, sf_dir):
    return _listed(spark, sf_dir)


@_query(f"SELECT DISTINCT CASE exchange WHEN 'N' THEN 'NYSE' ELSE 'AMEX' END AS index_name, ticker FROM ({_LISTED}) WHERE exchange IN ('N', 'A') AND NOT regexp_matches(lower(security_name), 'warrant|right|unit|preferred|notes|debenture|bond') AND regexp_full_match(ticker, '[A-Z]{{1,5}}')")
def exchange_rosters(spark, sf_dir):
    from ledgerline.sources import files

    return files.rosters(_listed(spark, sf_dir))


@_query("SELECT upper(concat('v', CAST(l_suppkey AS VARCHAR))) AS ticker, CAST(l_shipdate AS DATE) AS ex_date, t AS action_type, CASE t WHEN 'dividend' THEN l_discount ELSE l_tax END AS value FROM lineitem, (SELECT unnest(['dividend', 'split']) AS t) WHERE CASE t WHEN 'dividend' THEN l_discount ELSE l_tax END > 0")
def history_actions(spark, sf_dir):
    from ledgerline.sources import vendors

    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return vendors.history_actions(items.select(F.concat(F.lit("v"), F.col("l_suppkey").cast("string")).alias("ticker"), F.col("l_shipdate").alias("Date"), F.col("l_discount").alias("Dividends"), F.col("l_tax").alias("Stock Splits")))


@_query("SELECT upper(concat('v', CAST(l_suppkey AS VARCHAR))) AS ticker, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS open, l_extendedprice AS high, l_extendedprice AS low, l_extendedprice AS close, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS volume FROM lineitem WHERE l_linenumber % 3 <> 0")
def bulk_bars(spark, sf_dir):
    from ledgerline.sources import vendors

    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    price = F.when(F.col("l_linenumber") % 3 == 0, "none").otherwise(F.col("l_extendedprice").cast("string"))
    raw = items.select(F.concat(F.lit("v"), F.col("l_suppkey").cast("string")).alias("code"), F.col("l_shipdate").alias("date"), *(price.alias(c) for c in vendors.PRICES), F.when(F.col("l_linenumber") % 2 != 0, F.col("l_quantity").cast("string")).alias("volume"))
    return vendors.bulk_bars(raw)


@_query("""WITH e AS (SELECT upper(event_type) AS ticker, to_timestamp(floor(epoch(ts) / 60) * 60)::TIMESTAMP AS t, CAST(event_id % 500 AS DOUBLE) AS p, CAST(event_id % 90 AS BIGINT) AS v FROM events WHERE event_id % 7 <> 0),
m AS (SELECT ticker, t, min((p, v)) AS x FROM e GROUP BY 1, 2), l AS (SELECT *, (t AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local FROM m)
SELECT ticker, CAST(epoch(t) AS BIGINT) AS at, x[1] AS open, x[1] AS high, x[1] AS low, x[1] AS close, x[2] AS volume, CASE WHEN extract(hour FROM local) * 60 + extract(minute FROM local) BETWEEN 570 AND 959 THEN 'rth' ELSE 'ext' END AS segment FROM l""")
def intraday_bars(spark, sf_dir):
    from ledgerline.sources import vendors

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    minute = (F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 60) * 60).cast("long")
    raw = ev.select(F.col("event_type").alias("ticker"), minute.alias("timestamp"), *((F.col("event_id") % 500).cast("double").alias(c) for c in vendors.PRICES), F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 90).cast("long").alias("volume"))
    return vendors.intraday_bars(raw).select("ticker", F.unix_timestamp("ts").alias("at"), *vendors.PRICES, "volume", "segment")


@_query("""WITH w AS (SELECT provider, dataset, ticker, max(CAST(started_at AS DATE)) AS high FROM manifest WHERE status = 'ok' GROUP BY 1, 2, 3), k AS (SELECT DISTINCT provider, dataset, ticker FROM manifest),
p AS (SELECT k.*, CASE WHEN high IS NULL THEN DATE '1995-01-02' ELSE coalesce((SELECT min(session) FROM sessions WHERE session > high AND high BETWEEN (SELECT min(session) FROM sessions) AND (SELECT max(session) FROM sessions)), high + 1) END AS start FROM k LEFT JOIN w USING (provider, dataset, ticker))
SELECT provider, dataset, ticker, CAST(start AS DATE) AS start, DATE '1998-06-01' AS "end" FROM p WHERE start <= DATE '1998-06-01'""", ("manifest", "sessions"))
def fetch_plan(manifest, sessions):
    from ledgerline.functions import calendar
    from ledgerline.operators import ingest

    marks = manifest.where("status = 'ok'").groupBy("provider", "dataset", "ticker").agg(F.max(F.col("started_at").cast("date")).alias("high_water_date"))
    return ingest.fetch_plan(manifest, marks, calendar.calendar_map(sessions), "1995-01-02", "1998-06-01")


@_query("""WITH v AS (SELECT unnest(['c_custkey', 'c_mktsegment', 'c_nationkey']) AS "column", unnest([CAST(c_custkey AS VARCHAR), c_mktsegment, CAST(c_nationkey AS VARCHAR)]) AS x, unnest([c_custkey, NULL, c_nationkey]) AS n FROM customer),
k AS (SELECT "column", x, row_number() OVER (PARTITION BY "column" ORDER BY n, x) AS r FROM (SELECT DISTINCT * FROM v)) SELECT "column", max(CASE WHEN r = 1 THEN x END) AS example_1, max(CASE WHEN r = 2 THEN x END) AS example_2 FROM k GROUP BY 1""")
def column_examples(spark, sf_dir):
    from ledgerline.plans import gate

    return gate.examples(spark.read.parquet(f"{sf_dir}/customer.parquet"), ["c_custkey", "c_mktsegment", "c_nationkey"]).drop("type")


@_query("SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS ticker, 'c_acctbal' AS \"column\", c_acctbal + c_custkey % 3 * 100 AS value, c_acctbal AS actual, abs(c_acctbal - (c_acctbal + c_custkey % 3 * 100)) <= greatest(abs(c_acctbal) * 0.01, 1e-9) AS ok FROM customer WHERE c_custkey % 2 = 0")
def spot_check(spark, sf_dir):
    from ledgerline.plans import gate

    facts = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("ticker", F.concat(F.lit("C"), F.col("c_custkey").cast("string")))
    cited = facts.where("c_custkey % 2 = 0").select(F.lower("ticker").alias("ticker"), F.lit("c_acctbal").alias("column"), (F.col("c_acctbal") + F.col("c_custkey") % 3 * 100).alias("value"))
    return gate.spot_check(cited, facts.select("ticker", "c_acctbal"))


_GATED = "WITH s AS (SELECT ticker, date, close, 'drop table' AS word FROM bars) SELECT ticker, word, count(*) AS n, max(close) AS top FROM s WHERE close > 0 GROUP BY ticker, word"


@_query(_GATED, ("bars",))
def gated_sql(bars):
    from ledgerline.plans import gate

    spark = bars.sparkSession
    bars.createOrReplaceTempView("bars")
    return spark.sql(gate.guard(spark, _GATED, {"bars"}))


@_query("SELECT doc_id, CASE WHEN trim(coalesce(source, '')) = '' THEN coalesce(nullif(trim(lang), ''), '') WHEN trim(coalesce(lang, '')) = '' THEN trim(source) ELSE concat(trim(source), '. ', trim(lang)) END AS text FROM documents")
def article_text(spark, sf_dir):
    from ledgerline.operators import ingest

    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", ingest.article_text("source", "lang").alias("text"))


@_query()
def synthetic_bars(spark, sf_dir):
    from ledgerline.sources import synthetic

    synthetic.register(spark)
    return spark.read.format("synthetic_bars").options(tickers="AAA,BBB,CCC", start="2022-01-01", end="2023-12-31", seed="7", batch="1").load()


def queries() -> dict[str, Query]:
    from ledgerline.plans import catalog_jobs, catalog_lake, catalog_series  # noqa: F401  register their own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_oracles)


__all__ = ["FRAMES", "oracle_sql", "queries"]
