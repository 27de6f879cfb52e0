"""Anomalies as rows: nothing here changes a price. Flags: (ticker, date, flag_type, severity, detail as JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: scales a median absolute deviation to a standard deviation.
MAD_SCALE = 0.6745
GAP = "unexplained_gap"


def _by_date():
    return Window.partitionBy("ticker").orderBy("date")


def _flag(df: DataFrame, kind: str, severity: Column, **detail: Column) -> DataFrame:
    return df.select("ticker", "date", F.lit(kind).alias("flag_type"), severity.alias("severity"), F.to_json(F.struct(*(v.alias(k) for k, v in detail.items()))).alias("detail"))


def log_returns(bars: DataFrame) -> DataFrame:
    return bars.withColumn("r", F.ln("close") - F.ln(F.lag("close").over(_by_date())))


def _sliding(window: int, rows_at_once: int = 8192):
    """Adds r, med and mad to Arrow batches in which each ticker's bars follow each other by date. Of what came before, `window` returns and one close are kept."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        past, close, ticker = np.full(window, np.nan), np.nan, None
        low, high = (window - 1) // 2, window // 2

        def median(x):
            x.partition((low, high), axis=1)
            return (x[:, low] + x[:, high]) / 2

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            col = lambda name, b=batch: b.column(b.schema.get_field_index(name))
            names = pa.concat_arrays([pa.array([ticker], col("ticker").type), col("ticker")])
            same = pc.fill_null(pc.equal(names[1:], names[:-1]), False).to_numpy(zero_copy_only=False) | (pc.is_null(names[1:]).to_numpy(zero_copy_only=False) & pc.is_null(names[:-1]).to_numpy(zero_copy_only=False))
            price = np.asarray(col("close").cast(pa.float64()).to_numpy(zero_copy_only=False), float)
            with np.errstate(invalid="ignore", divide="ignore"):
                logs = np.where(price > 0, np.log(price), np.nan)
            r = np.where(same, np.diff(np.concatenate(([close], logs))), np.nan)
            # a ticker's first bar has no return, so that no full window of a later bar reaches over the start of its series
            series = np.concatenate((past, r))
            holes = np.concatenate(([0], np.cumsum(np.isnan(series))))
            full = np.flatnonzero((holes[window : window + n] == holes[:n]) & same)
            views = np.lib.stride_tricks.sliding_window_view(series, window)
            med, mad = np.full(n, np.nan), np.full(n, np.nan)
            for at in range(0, len(full), rows_at_once):
                rows = full[at : at + rows_at_once]
                x = views[rows]
                med[rows] = median(x)
                np.subtract(x, med[rows, None], out=x)
                mad[rows] = median(np.abs(x, out=x))
            mad[mad == 0] = np.nan
            past, close, ticker = series[-window:], logs[-1], names[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(a, from_pandas=True) for a in (r, med, mad))], names=[*batch.schema.names, "r", "med", "mad"])

    return run


def robust_scores(bars: DataFrame, window: int = 63) -> DataFrame:
    """Bars with r, med, mad and z over the `window` returns before each bar; null unless the window is full or if mad is 0.

    One exchange by ticker; then each task slides over its tickers' bars in order and holds no more of the past than the window.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bars.schema.fields)
    rows = bars.repartition("ticker").sortWithinPartitions("ticker", "date").mapInArrow(_sliding(window), f"{schema}, r double, med double, mad double")
    return rows.withColumn("z", MAD_SCALE * (F.col("r") - F.col("med")) / F.col("mad"))


def _runs(bars: DataFrame, same: Column, name: str) -> DataFrame:
    """Bars with the length of the unbroken run in which `same` links each bar to the one before."""
    island = bars.withColumn("__i", F.sum(F.when(same, 0).otherwise(1)).over(_by_date().rowsBetween(Window.unboundedPreceding, 0)))
    return island.withColumn(name, F.count("*").over(Window.partitionBy("ticker", "__i"))).drop("__i")


def measured(bars: DataFrame, window: int | None = 63) -> DataFrame:
    """Bars with all that the detectors look at, from one exchange by ticker: change, stale_run and zero_run, and r, med, mad and z unless window is None."""
    rows = bars.repartition("ticker").withColumns({"__prev": F.lag("close").over(_by_date()), "__zero": F.col("volume") == 0})
    rows = rows.withColumns({"change": F.try_divide("close", "__prev") - 1, "__before": F.lag("__zero").over(_by_date())})
    rows = _runs(rows, F.col("close") == F.col("__prev"), "stale_run")
    rows = _runs(rows, F.col("__zero") & F.col("__before"), "zero_run").drop("__prev", "__before", "__zero")
    if window is None:
        return rows
    # windows by ticker keep the rows where the exchange put them, so that a sort is enough
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    slid = rows.sortWithinPartitions("ticker", "date").mapInArrow(_sliding(window), f"{schema}, r double, med double, mad double")
    return slid.withColumn("z", MAD_SCALE * (F.col("r") - F.col("med")) / F.col("mad"))


def _outlier(window: int, threshold: float):
    return "return_outlier_mad", F.abs("z") > threshold, F.lit("warn"), {"log_return": F.round("r", 6), "robust_z": F.round("z", 2), "window": F.lit(window)}


def _stale(least: int):
    return "stale_price", F.col("stale_run") >= least, F.when(F.col("volume") > 0, "warn").otherwise("info"), {"run_length": F.col("stale_run")}


def _still(least: int):
    return "zero_volume_run", (F.col("volume") == 0) & (F.col("zero_run") >= least), F.lit("info"), {"run_length": F.col("zero_run")}


def _gap(limit: float):
    return GAP, F.abs("change") > limit, F.lit("error"), {"pct_change": F.round("change", 6)}


def _raised(rows: DataFrame, *tests) -> DataFrame:
    """A flag for each test that a bar meets."""
    one = lambda kind, hit, severity, detail: F.when(hit, F.struct(F.lit(kind).alias("flag_type"), severity.alias("severity"), F.to_json(F.struct(*(v.alias(k) for k, v in detail.items()))).alias("detail")))
    return rows.select("ticker", "date", F.inline(F.array_compact(F.array(*(one(*t) for t in tests)))))


def _explained(flags: DataFrame, actions: DataFrame) -> DataFrame:
    """flags without gaps on days of an action."""
    known = actions.select("ticker", F.col("ex_date").alias("date"), F.lit(GAP).alias("flag_type")).distinct()
    return flags.join(known, ["ticker", "date", "flag_type"], "left_anti")


def mad_outliers(bars: DataFrame, window: int = 63, threshold: float = 8.0) -> DataFrame:
    return _raised(robust_scores(bars, window), _outlier(window, threshold))


def stale_prices(bars: DataFrame, least: int = 5) -> DataFrame:
    return _raised(measured(bars, None), _stale(least))


def zero_volume_runs(bars: DataFrame, least: int = 3) -> DataFrame:
    return _raised(measured(bars, None), _still(least))


def unexplained_gaps(bars: DataFrame, actions: DataFrame, limit: float = 0.30) -> DataFrame:
    return _explained(_raised(measured(bars, None), _gap(limit)), actions)


def numbered(sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of sessions (calendar, session): (calendar, session, seq) counted from 1, and (calendar, day, seq, open) for each day from a calendar's first to its last session: how many sessions there are up to that day, and whether it is one."""
    own = sessions.select("calendar", "session").distinct().withColumn("seq", F.row_number().over(Window.partitionBy("calendar").orderBy("session")))
    later = F.lead("session", 1).over(Window.partitionBy("calendar").orderBy("session"))
    spans = own.withColumn("end", F.coalesce(F.date_sub(later, 1), "session"))
    return own, spans.select("calendar", F.explode(F.sequence("session", "end")).alias("day"), "seq", "session").select("calendar", "day", "seq", (F.col("day") == F.col("session")).alias("open"))


def missing_sessions(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions (calendar, session) between a ticker's first and last bar on which it has none, for each calendar.

    Each bar gets the number of sessions up to its day from a table of days, which is as long as the calendars' years. Where that
    number grows by more than one from a ticker's bar to its next, the sessions in between are missing: rows are made for these alone.
    """
    own, days = numbered(sessions)
    spans = own.groupBy("calendar").agg(F.min("session").alias("__lo"), F.max("seq").alias("__n"))
    days = days.select(F.col("calendar").alias("__c"), "day", "seq", "open")
    placed = bars.select("ticker", "date").where("date is not null").join(F.broadcast(spans)).join(F.broadcast(days), (F.col("calendar") == F.col("__c")) & (F.col("date") == F.col("day")), "left")
    upto = F.coalesce("seq", F.when(F.col("date") < F.col("__lo"), 0).otherwise(F.col("__n")))
    run = Window.partitionBy("ticker", "calendar").orderBy("date")
    gaps = placed.select("ticker", "calendar", "date", upto.alias("upto"), F.coalesce("open", F.lit(False)).cast("int").alias("open")).withColumn("since", F.lag("upto").over(run))
    gaps = gaps.where("upto - open > since").select("ticker", "calendar", F.explode(F.sequence(F.col("since") + 1, F.col("upto") - F.col("open"))).alias("seq"))
    found = gaps.join(F.broadcast(own.select("calendar", "seq", F.col("session").alias("date"))), ["calendar", "seq"])
    return _flag(found, "missing_session", F.lit("warn"), calendar=F.col("calendar"))


def battery(bars: DataFrame, actions: DataFrame, sessions: DataFrame, window: int = 63, threshold: float = 8.0, stale: int = 5, zero: int = 3, gap: float = 0.30) -> DataFrame:
    """All detectors: those of a ticker's series in one pass, and missing sessions."""
    raised = _raised(measured(bars, window), _outlier(window, threshold), _stale(stale), _still(zero), _gap(gap))
    return _explained(raised, actions).unionByName(missing_sessions(bars, sessions), allowMissingColumns=False)


def trailing_slice(bars: DataFrame, mad_window: int = 63, least: int = 260) -> DataFrame:
    """Each ticker's last bars, as many as an incremental check needs."""
    rn = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    return bars.withColumn("__rn", rn).where(F.col("__rn") <= max(4 * mad_window, least)).drop("__rn")


def clean_view(bars: DataFrame, flags: DataFrame) -> DataFrame:
    """Bars with n_flags and the sorted distinct flag_types of their day."""
    kinds = flags.groupBy("ticker", "date").agg(F.count("*").alias("n_flags"), F.array_join(F.array_sort(F.collect_set("flag_type")), ",").alias("flag_types"))
    return bars.join(kinds, ["ticker", "date"], "left").withColumn("n_flags", F.coalesce("n_flags", F.lit(0)))


def flag_summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("flag_type", "severity").agg(F.count("*").alias("n"))


def most_flagged(flags: DataFrame, n: int = 10) -> DataFrame:
    return flags.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(n)
