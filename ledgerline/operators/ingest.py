"""What to fetch next, from watermarks and sessions; and scores for texts that have none."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fetch_plan(wanted: DataFrame, watermarks: DataFrame, days: DataFrame, default_start, end) -> DataFrame:
    """(provider, dataset, ticker, start, end) for each wanted (provider, dataset, ticker) that isn't up to date.

    start: the first session after the watermark, or default_start without one. days: a calendar map of one calendar;
    a watermark outside it starts on the next day. Rows whose start is after `end` go.
    """
    key = ["provider", "dataset", "ticker"]
    known = wanted.select(key).distinct().join(watermarks.select(*key, F.col("high_water_date").alias("__high")), key, "left")
    after = days.select(F.col("any_date").alias("__high"), "next_session")
    start = F.when(F.col("__high").isNull(), F.lit(default_start).cast("date")).otherwise(F.coalesce("next_session", F.date_add("__high", 1)))
    out = known.join(after, "__high", "left").select(*key, start.alias("start"), F.lit(end).cast("date").alias("end"))
    return out.where("start <= end")


def trimmed(payload: DataFrame, plan: DataFrame, day: str = "date") -> DataFrame:
    """Payload rows from each ticker's own start on; a batch is fetched over the widest span. Rows without a day, as failures have none, stay."""
    starts = plan.select(F.upper("ticker").alias("__t"), F.col("start").alias("__start")).distinct()
    joined = payload.join(starts, F.upper("ticker") == F.col("__t"))
    return joined.where(F.col(day).isNull() | (F.to_date(day) >= F.col("__start"))).drop("__t", "__start")


def batches(plan: DataFrame, size: int = 200) -> DataFrame:
    """plan with batch: tickers of one provider whose datasets start on the same days go together, at most about `size` to a batch."""
    groups = plan.groupBy("provider", "ticker").agg(F.array_sort(F.collect_set(F.concat_ws("@", "dataset", "start"))).alias("signature"))
    sizes = groups.groupBy("provider", "signature").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("ticker"), F.ceil(F.col("n") / size))
    named = groups.join(sizes, ["provider", "signature"]).select("provider", "ticker", F.concat_ws(":", "provider", F.concat_ws(",", "signature"), part.cast("string")).alias("batch"))
    return plan.join(named, ["provider", "ticker"])


def high_waters(fetched: DataFrame) -> DataFrame:
    """Watermark rows after a run (provider, dataset, ticker, status, last_date, end): a fetch without rows or with an error doesn't advance; actions advance to the requested end at least."""
    ok = fetched.where("status = 'ok' and last_date is not null")
    high = F.when(F.col("dataset") == "corporate_actions", F.greatest("last_date", "end")).otherwise(F.col("last_date"))
    return ok.groupBy("provider", "dataset", "ticker").agg(F.max(high).alias("high_water_date"))


def day_plan(high_water, last, pages_a_day: int, quota: int = 25) -> tuple[list, bool]:
    """(days to fetch after the stream's high-water date, whether they may need more requests than the quota)."""
    days = [d.date() for d in pd.date_range(pd.Timestamp(high_water) + pd.Timedelta(days=1), pd.Timestamp(last), freq="D")]
    return days, len(days) * pages_a_day > quota


def pending(rows: DataFrame, column: str, key: list[str], limit: int | None = None) -> DataFrame:
    """Rows without a score; with a limit, the first ones by key."""
    left = rows.where(F.col(column).isNull())
    return left if limit is None else left.orderBy(*key).limit(limit)


def article_text(title: str = "title", summary: str = "summary") -> Column:
    """'title. summary', or the one that isn't blank."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.concat_ws(". ", text(title), text(summary))


def scorer(load: Callable[[], Callable[[list[str]], list[float]]], batch: int = 32):
    """A column function text -> double. load() makes the model, once in each Python worker; it takes lists of at most `batch` texts. Null texts have no score."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in parts:
            there = texts.dropna()
            found: list[float] = []
            for i in range(0, len(there), batch):
                found += list(model([str(t) for t in there.iloc[i : i + batch]]))
            yield pd.Series(found, index=there.index, dtype="float64").reindex(texts.index)

    return score


def with_scores(rows: DataFrame, articles: DataFrame, score, revision: str, column: str = "score_finbert") -> DataFrame:
    """rows with the column filled where it was null, from the article's text; only the score's columns change."""
    text = articles.select("article_id", article_text().alias("__text"))
    open_ = F.col(column).isNull()
    done = rows.join(text, "article_id", "left").withColumn("__s", F.when(open_ & (F.col("__text") != ""), F.col("__text"))).withColumn("__s", score("__s"))
    return done.withColumns({column: F.coalesce(column, "__s"), "finbert_revision": F.when(F.col("__s").isNotNull(), F.lit(revision)).otherwise(F.col("finbert_revision"))}).drop("__text", "__s")
