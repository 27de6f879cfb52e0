"""Validation, reconciliation, rosters, histories and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: check name -> condition that a good row meets.
OHLCV = {
    **{f"{c}_positive": f"{c} > 0" for c in ("open", "high", "low", "close")}, "volume_nonnegative": "volume >= 0", "high_ge_low": "high >= low",
    "high_ge_open": "high >= open", "high_ge_close": "high >= close", "low_le_open": "low <= open", "low_le_close": "low <= close",
}
ACTIONS = {"action_known": "action_type in ('split', 'dividend')", "value_positive": "value > 0"}
ARTICLES = {"article_id_hex": "article_id rlike '^[0-9a-f]{64}$'", "overall_in_range": "overall_sentiment_score is null or abs(overall_sentiment_score) <= 1"}
TICKER_SENTIMENT = {"ticker_length": "length(ticker) between 1 and 12", "relevance_in_range": "relevance is null or relevance between 0 and 1", "score_in_range": "score_av is null or abs(score_av) <= 1"}
#: Words in a security's name that mark it as no common stock, as substrings.
NOT_COMMON = "warrant|right|unit|preferred|notes|debenture|bond"


def validated(df: DataFrame, checks: dict[str, str], key: list[str], required: list[str] = (), slices: int = 16) -> DataFrame:
    """df with failed: the names of the checks that a row fails. A null in a required column fails not_null_<column>; a row whose key is repeated fails unique_key, where nulls are equal (such rows fail not_null as well).

    Keys are counted in parts first, and rows meet the repeated ones in `slices` shares of each key, so that a key that a third of all
    rows have isn't one task's. slices=0: rows come with few to a key, and already lie by their keys; they are counted in place.
    """
    tests: list[Column] = [F.when(F.col(c).isNull(), F.lit(f"not_null_{c}")) for c in required]
    tests += [F.when(~F.coalesce(F.expr(cond), F.lit(True)), F.lit(name)) for name, cond in checks.items()]
    if not slices:
        tests.append(F.when(F.count("*").over(Window.partitionBy(*key)) > 1, F.lit("unique_key")))
        return df.withColumn("failed", F.array_compact(F.array(*tests)))
    own = [f"__key{i}" for i in range(len(key))]
    repeated = df.groupBy(*(F.col(k).alias(o) for k, o in zip(key, own, strict=True))).agg(F.count("*").alias("__n")).where("__n > 1")
    repeated = repeated.select(*own, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("__part"))
    met = F.col("__slice") == F.col("__part")
    for k, o in zip(key, own, strict=True):
        met = met & F.col(k).eqNullSafe(F.col(o))
    rows = df.withColumn("__slice", F.spark_partition_id() % slices).join(repeated, met, "left")
    tests.append(F.when(F.col("__part").isNotNull(), F.lit("unique_key")))
    return rows.withColumn("failed", F.array_compact(F.array(*tests))).drop("__slice", "__part", *own)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, one row for each failed check)."""
    return df.where(F.size("failed") == 0).drop("failed"), df.where(F.size("failed") > 0).withColumn("check", F.explode("failed")).drop("failed")


def coerce_numeric(df: DataFrame, share: float = 0.8, keep: tuple[str, ...] = (), nulls: tuple[str, ...] = ("", "n/a", "N/A", "NA", "NaN", "nan", "null", "NULL", "None", "-")) -> DataFrame:
    """Text columns become double where at least `share` of their non-null cells are numbers; columns ending in 'date' and those in keep stay. One pass decides for all."""
    names = [c for c, t in df.dtypes if t == "string" and c not in keep and not c.lower().endswith("date")]
    clean = df.withColumns({c: F.when(~F.trim(F.col(f"`{c}`")).isin(*nulls), F.col(f"`{c}`")) for c in names})
    if not names:
        return clean
    number = lambda c: F.expr(f"try_cast(trim(`{c}`) as double)")
    n = clean.agg(*(F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(names)), *(F.count(number(c)).alias(f"k{i}") for i, c in enumerate(names))).first()
    return clean.withColumns({c: number(c) for i, c in enumerate(names) if n[f"n{i}"] and n[f"k{i}"] >= share * n[f"n{i}"]})


def reconcile(a: DataFrame, b: DataFrame, fields: list[str], names: tuple[str, str] = ("a", "b"), price_tol: float = 0.005, volume_tol: float = 0.10) -> DataFrame:
    """(ticker, date, field, value_a, value_b, rel_diff, classification): fields that don't match, and keys that one side lacks (field null)."""
    left = a.select("ticker", "date", *(F.col(f).cast("double").alias(f"a_{f}") for f in fields), F.lit(1).alias("in_a"))
    right = b.select("ticker", "date", *(F.col(f).cast("double").alias(f"b_{f}") for f in fields), F.lit(1).alias("in_b"))
    both = left.join(right, ["ticker", "date"], "full")
    one = both.where("in_a is null or in_b is null").select("ticker", "date", F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("value_a"), F.lit(None).cast("double").alias("value_b"), F.lit(None).cast("double").alias("rel_diff"), F.when(F.col("in_b").isNull(), f"missing_in_{names[1]}").otherwise(f"missing_in_{names[0]}").alias("classification"))
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("value_a"), F.col(f"b_{f}").alias("value_b")) for f in fields))
    rows = both.where("in_a is not null and in_b is not null").select("ticker", "date", F.inline(cells))
    rel = F.abs(F.col("value_a") - F.col("value_b")) / F.greatest(F.abs("value_a"), F.abs("value_b"), F.lit(1e-12))
    tol = F.when(F.col("field") == "volume", volume_tol).otherwise(price_tol)
    kind = F.when(F.col("rel_diff") == 0, "match").when(F.col("rel_diff") <= tol, "within_tolerance").otherwise("discrepancy")
    out = rows.withColumn("rel_diff", F.when(F.col("value_a").isNotNull() & F.col("value_b").isNotNull(), rel)).withColumn("classification", kind).where("classification <> 'match'")
    return out.unionByName(one)


def members_as_of(membership: DataFrame, day, index_name: str) -> DataFrame:
    d = F.lit(day).cast("date")
    return membership.where((F.col("index_name") == index_name) & (F.col("effective_from") <= d) & (F.col("effective_to").isNull() | (d < F.col("effective_to")))).select("ticker").distinct()


def membership_diff(current: DataFrame, target: DataFrame, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """(*keys, change): 'add', 'close' or 'keep'."""
    c, t = current.select(*keys, F.lit(1).alias("c")).distinct(), target.select(*keys, F.lit(1).alias("t")).distinct()
    change = F.when(F.col("c").isNull(), "add").when(F.col("t").isNull(), "close").otherwise("keep")
    return c.join(t, list(keys), "full").select(*keys, change.alias("change"))


def history_merge(history: DataFrame, incoming: DataFrame, key: str, fields: list[str], day) -> DataFrame:
    """Interval history after a snapshot: unchanged rows stay, a changed open row is closed at `day` and opened anew (the same day: overwritten), new keys open."""
    d = F.lit(day).cast("date")
    new = incoming.select(key, *(F.col(f).alias(f"n_{f}") for f in fields), F.lit(1).alias("seen"))
    joined = history.join(new, key, "left").withColumn("changed", F.col("effective_to").isNull() & F.col("seen").isNotNull() & ~_all_equal(fields))
    old = joined.where(~(F.col("changed") & (F.col("effective_from") >= d))).select(key, *fields, "effective_from", F.when(F.col("changed"), d).otherwise(F.col("effective_to")).alias("effective_to"))
    opened = joined.where("effective_to is null and not changed and seen is not null").select(key).distinct()
    fresh = incoming.join(opened, key, "left_anti").select(key, *fields, d.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"))
    return old.unionByName(fresh)


def _all_equal(fields: list[str]) -> Column:
    out = F.lit(True)
    for f in fields:
        out = out & F.col(f).eqNullSafe(F.col(f"n_{f}"))
    return out


def common_stocks(directory: DataFrame, name: str = "security_name", statuses: tuple[str, ...] | None = ("N", "D")) -> DataFrame:
    keep = (F.col("test_issue") == "N") & (F.col("etf") == "N") & ~F.coalesce(F.col(name).rlike(f"(?i){NOT_COMMON}"), F.lit(False)) & F.col("ticker").rlike("^[A-Z]{1,5}$")
    return directory.where(keep & F.col("financial_status").isin(*statuses) if statuses else keep)


def run_rollup(manifest: DataFrame, n: int = 10) -> DataFrame:
    out = manifest.groupBy("run_id", "provider", "dataset").agg(F.min("started_at").alias("started_at"), F.count("*").alias("n"), F.sum((F.col("status") == "ok").cast("long")).alias("ok"), F.sum((F.col("status") == "failed").cast("long")).alias("failed"), F.sum("rows_fetched").alias("rows_fetched"))
    return out.orderBy(F.desc("started_at"), "run_id", "provider", "dataset").limit(n)


def watermark_latest(log: DataFrame) -> DataFrame:
    return log.groupBy("provider", "dataset", "ticker").agg(F.max_by("high_water_date", F.struct("updated_at", "high_water_date")).alias("high_water_date"))


def sector_concentration(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("sector").agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def ghosts(cited: DataFrame, *known: DataFrame) -> DataFrame:
    every = known[0].select("ticker")
    for k in known[1:]:
        every = every.union(k.select("ticker"))
    return cited.select("ticker").distinct().join(every.distinct(), "ticker", "left_anti")
