"""The lake's jobs: what a command line would run, as methods that take and give frames."""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import adjust, dedupe, detect, ingest, news, reports, research, tables
from ledgerline.plans import gate
from ledgerline.sources import files, store
from ledgerline.streaming import first_capture

PRICES = ["open", "high", "low", "close"]
#: table -> (schema, key, partition).
TABLES = {
    "ohlcv_daily": ("ticker string, date date, open double, high double, low double, close double, volume long, source string, run_id string, ingested_at timestamp, year int", ["ticker", "date"], "year"),
    "corporate_actions": ("ticker string, ex_date date, action_type string, value double, source string, run_id string, ingested_at timestamp", ["ticker", "ex_date", "action_type"], None),
    "validation_flags": ("ticker string, date date, flag_type string, severity string, detail string, run_id string, flagged_at timestamp, year int", ["ticker", "date", "flag_type"], "year"),
    "universe_membership": ("index_name string, ticker string, effective_from date, effective_to date, source string, note string", ["index_name", "ticker", "effective_from"], None),
    "security_master": ("ticker string, exchange string, gic_sector string, gic_group string, gic_industry string, gic_sub_industry string, effective_from date, effective_to date", ["ticker", "effective_from"], None),
    "fundamentals_snapshot": ("ticker string, as_of date, note string", ["as_of", "ticker"], None),
    "listing": ("directory string, ticker string, as_of date, security_name string, exchange string, market_category string, etf string, test_issue string, financial_status string, round_lot_size double", ["directory", "ticker", "as_of"], None),
    "news_articles": ("article_id string, published_at timestamp, ingested_at timestamp, source string, provider string, title string, summary string, url string, overall_sentiment_score double, year int", ["article_id"], "year"),
    "news_ticker_sentiment": ("article_id string, ticker string, published_at timestamp, ingested_at timestamp, relevance double, score_av double, score_finbert double, finbert_revision string, year int", ["article_id", "ticker"], "year"),
    "sentiment_daily": ("ticker string, date date, sent_av double, sent_finbert double, n_articles long, log_n_articles double, rel_sum double, year int", ["ticker", "date"], "year"),
}
_LOGS = {
    "manifest": "run_id string, provider string, dataset string, ticker string, start date, end date, rows_fetched long, status string, error string, started_at timestamp",
    "watermarks": "provider string, dataset string, ticker string, high_water_date date, run_id string, updated_at timestamp",
    "promotions": "provider string, dataset string, batch long, run_ids array<string>, files long, rows_read long, taken_at timestamp",
}


def canonical_bars(raw: DataFrame) -> DataFrame:
    """Upper-case tickers, dates without time, numbers or null."""
    return raw.withColumns({"ticker": F.upper(F.trim("ticker")), "date": F.to_date("date"), "volume": F.col("volume").try_cast("double").cast("long")} | {c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in PRICES})


def canonical_actions(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"ticker": F.upper(F.trim("ticker")), "ex_date": F.to_date("ex_date"), "action_type": F.lower("action_type"), "value": F.col("value").try_cast("double")})


class Lake:
    """Curated tables, logs and quarantine under one root. sessions: (calendar, session) of the bars' calendar."""

    def __init__(self, spark: SparkSession, root: str, sessions: DataFrame):
        self.spark, self.root, self.sessions = spark, root.rstrip("/"), sessions
        self._held: list[DataFrame] = []

    def table(self, name: str) -> DataFrame:
        return store.read_table(self.spark, f"{self.root}/curated/{name}", TABLES[name][0])

    def _log(self, name: str) -> DataFrame:
        path = f"{self.root}/state/{name}"
        fs, where = store._fs(self.spark, path)
        return self.spark.read.schema(_LOGS[name]).parquet(path) if fs.exists(where) else self.spark.createDataFrame([], _LOGS[name])

    def _put(self, name: str, df: DataFrame, by: str | None = None, first: bool = False) -> dict[str, int]:
        schema, key, partition = TABLES[name]
        wanted = [part.split(" ")[0] for part in schema.split(", ")]
        kinds = dict(part.split(" ") for part in schema.split(", "))
        if partition == "year" and "year" not in df.columns and "published_at" in df.columns:
            df = df.withColumn("year", F.year("published_at"))
        every = wanted + [c for c in df.columns if c not in wanted and name == "fundamentals_snapshot"]
        shaped = df.select(*((F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in every))
        try:
            return store.upsert(shaped, f"{self.root}/curated/{name}", key, partition, by or ("ingested_at" if "ingested_at" in every else None), first)
        finally:
            while self._held:
                self._held.pop().unpersist()

    def _valid(self, df: DataFrame, checks: dict[str, str], key: list[str], required: list[str], dataset: str, run_id: str) -> DataFrame:
        """Rows that pass; the others, a row for each failed check, go to quarantine."""
        checked = tables.validated(df, checks, key, required, slices=0).persist()  # one row a key by now; read twice; _put lets it go
        self._held.append(checked)
        good, bad = tables.split_valid(checked)
        store.append_log(bad.withColumn("run_id", F.lit(run_id)), f"{self.root}/quarantine/{dataset}")
        return good

    def views(self) -> list[str]:
        """Registers all tables and the derived views, and gives their names."""
        frames = {name: self.table(name) for name in TABLES}
        bars = frames["ohlcv_daily"]
        frames["adjustment_factors"] = adjust.adjustment_factors(bars, frames["corporate_actions"])
        frames["ohlcv_daily_adj"] = adjust.adjusted(bars, frames["corporate_actions"], tuple(PRICES))
        frames["ohlcv_daily_clean"] = detect.clean_view(bars, frames["validation_flags"])
        frames["sentiment_decayed"] = news.decayed(bars, frames["sentiment_daily"], "sent_av")
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
        return sorted(frames)

    def curate_actions(self, raw: DataFrame, run_id: str | None = None) -> dict[str, int]:
        run_id = run_id or uuid.uuid4().hex
        key = TABLES["corporate_actions"][1]
        rows = dedupe.latest_wins(canonical_actions(raw), key, "ingested_at", ["value"])
        return self._put("corporate_actions", self._valid(rows, tables.ACTIONS, key, [*key, "value"], "corporate_actions", run_id).withColumn("run_id", F.lit(run_id)))

    def curate_bars(self, raw: DataFrame, run_id: str | None = None) -> dict[str, int]:
        """Bars into the table; detectors run over the recent bars of the tickers that came in."""
        run_id = run_id or uuid.uuid4().hex
        key = ["ticker", "date"]
        rows = dedupe.latest_wins(canonical_bars(raw), key, "ingested_at", ["close", "volume"])
        good = self._valid(rows, tables.OHLCV, key, [*key, *PRICES, "volume"], "ohlcv_daily", run_id)
        done = self._put("ohlcv_daily", good.withColumns({"year": F.year("date"), "run_id": F.lit(run_id)}))
        came = canonical_bars(raw).select("ticker").distinct()
        self.validate(detect.trailing_slice(self.table("ohlcv_daily").join(came, "ticker", "left_semi")), run_id)
        return done

    def validate(self, bars: DataFrame | None = None, run_id: str | None = None) -> dict[str, int]:
        """All detectors over the bars (None: the whole history), flags by key."""
        flags = detect.battery(self.table("ohlcv_daily") if bars is None else bars, self.table("corporate_actions"), self.sessions)
        return self._put("validation_flags", flags.withColumns({"run_id": F.lit(run_id or uuid.uuid4().hex), "flagged_at": F.current_timestamp(), "year": F.year("date")}))

    def curate_news(self, raw: DataFrame, run_id: str | None = None) -> dict[str, dict[str, int]]:
        """Articles and their tickers, as news.parse_feed gives them with ingested_at; what was captured first stays."""
        run_id = run_id or uuid.uuid4().hex
        articles = dedupe.first_wins(raw, ["article_id"], "ingested_at", ["url"]).join(self.table("news_articles").select("article_id"), "article_id", "left_anti")
        articles = self._valid(articles, tables.ARTICLES, ["article_id"], ["article_id", "published_at"], "news_articles", run_id)
        pairs = dedupe.first_wins(raw.where("ticker is not null"), ["article_id", "ticker"], "ingested_at", ["relevance"])
        pairs = pairs.join(self.table("news_ticker_sentiment").select("article_id", "ticker"), ["article_id", "ticker"], "left_anti")
        pairs = self._valid(pairs, tables.TICKER_SENTIMENT, ["article_id", "ticker"], ["article_id", "ticker"], "news_ticker_sentiment", run_id)
        return {"articles": self._put("news_articles", articles), "tickers": self._put("news_ticker_sentiment", pairs)}

    def score_news(self, score, revision: str) -> dict[str, int]:
        open_ = ingest.pending(self.table("news_ticker_sentiment"), "score_finbert", ["article_id", "ticker"])
        return self._put("news_ticker_sentiment", ingest.with_scores(open_, self.table("news_articles"), score, revision))

    def build_sentiment(self, calendar_map: DataFrame, since=None) -> dict[str, int]:
        """Daily factors from the session that each article counts for; since: only days from then on are made anew.

        Articles whose market has no calendar here, or none that reaches their day, go to quarantine under `sentiment_daily`; their number is given as rows_undated.
        """
        rows = news.trading_day(news.effective(self.table("news_ticker_sentiment")), calendar_map).persist()
        try:
            name = news.market()[1]
            undated = rows.where("date is null").select("article_id", "ticker", "effective_ts", F.lit("no_session").alias("check"), name.alias("calendar"))
            if n := undated.count():
                store.append_log(undated, f"{self.root}/quarantine/sentiment_daily")
            days = news.sentiment_daily(rows.where("date is not null"), scores=("score_av", "score_finbert"))
            days = days if since is None else days.where(F.col("date") >= F.lit(since).cast("date"))
            return self._put("sentiment_daily", days.withColumn("year", F.year("date"))) | {"rows_undated": n}
        finally:
            rows.unpersist()

    def refresh_roster(self, target: DataFrame, as_of, source: str) -> DataFrame:
        """Opens and closes memberships so that those open at as_of are target (index_name, ticker); only rosters in target are touched. Gives the changes."""
        d, key = F.lit(as_of).cast("date"), ["index_name", "ticker"]
        now = self.table("universe_membership").where("effective_to is null").join(target.select("index_name").distinct(), "index_name", "left_semi")
        diff = tables.membership_diff(now, target, tuple(key)).where("change <> 'keep'")
        closed = now.join(diff.where("change = 'close'").select(key), key, "left_semi").withColumn("effective_to", d)
        opened = diff.where("change = 'add'").select(*key, d.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), F.lit(source).alias("source"), F.lit("").alias("note"))
        self._put("universe_membership", closed.unionByName(opened))
        return diff

    def refresh_master(self, rows: DataFrame, as_of) -> dict[str, int]:
        fields = ["exchange", "gic_sector", "gic_group", "gic_industry", "gic_sub_industry"]
        return self._put("security_master", tables.history_merge(self.table("security_master").select("ticker", *fields, "effective_from", "effective_to"), rows, "ticker", fields, as_of))

    def take_fundamentals(self, raw: DataFrame, as_of, note: str = "") -> dict[str, int]:
        return self._put("fundamentals_snapshot", tables.coerce_numeric(files.screener(raw, as_of, note), keep=("ticker", "note", "sector", "industry")))

    def _taken(self, provider: str, dataset: str, fetch, plan: DataFrame, run_id: str, day: str) -> str | None:
        """Fetches one plan, writes its payload from each ticker's own start on, and gives the error if there was one."""
        try:
            store.write_raw(ingest.trimmed(fetch(plan), plan, day).withColumn("ingested_at", F.current_timestamp()), self.root, provider, dataset, run_id)
        except Exception as e:  # one vendor's answer must not stop the run  # noqa: BLE001
            return f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]
        return None

    def ingest(self, provider: str, dataset: str, fetch, wanted: DataFrame, days: DataFrame, default_start, end, size: int = 200) -> DataFrame:
        """Fetches what is missing and gives the run's manifest rows.

        fetch(plan) returns the payload (ticker, date or ex_date, ...) for a plan of (provider, dataset, ticker, start, end);
        a `status` column other than 'ok' marks a ticker as failed, with its `error`. Tickers that start on one day are fetched
        together, about `size` at a time; where that fails, one by one, so that a failure is a ticker's own. Tickers without rows keep their watermark.
        """
        run_id, day = uuid.uuid4().hex, "ex_date" if dataset == "corporate_actions" else "date"
        plan = ingest.fetch_plan(wanted, tables.watermark_latest(self._log("watermarks")), days, default_start, end)
        path = f"{self.root}/state/plans/{run_id}"
        ingest.batches(plan, size).write.parquet(path)  # what was asked doesn't change while it's answered
        batched = self.spark.read.parquet(path)
        plan, runs, failed = batched.drop("batch"), [], []
        for n, (batch,) in enumerate(batched.select("batch").distinct().orderBy("batch").collect()):
            part = batched.where(F.col("batch") == batch).drop("batch")
            name = f"{run_id}-{n:05}"
            if self._taken(provider, dataset, fetch, part, name, day) is None:
                runs.append(name)
                continue
            for k, (ticker,) in enumerate(part.select("ticker").distinct().orderBy("ticker").collect()):  # a batch's tickers
                alone = f"{name}-{k:05}"
                error = self._taken(provider, dataset, fetch, part.where(F.col("ticker") == ticker), alone, day)
                if error is None:
                    runs.append(alone)
                else:
                    failed.append((ticker, "failed", error))
        got = self.raw_frame(provider, dataset, runs=runs)
        got = self.spark.createDataFrame([], f"ticker string, {day} date") if got is None else got
        if failed:
            got = got.unionByName(self.spark.createDataFrame(failed, "ticker string, status string, error string"), allowMissingColumns=True)
        status = F.col("status") if "status" in got.columns else F.lit("ok")
        error = F.col("error") if "error" in got.columns else F.lit(None).cast("string")
        sums = got.groupBy("ticker").agg(F.max(F.to_date(day)).alias("last_date"), F.count(day).alias("rows_fetched"), F.max(F.when(status != "ok", status)).alias("bad"), F.max(error).alias("error"))
        run = plan.join(sums, "ticker", "left").withColumns({"status": F.coalesce("bad", F.lit("ok")), "rows_fetched": F.coalesce("rows_fetched", F.lit(0).cast("long")), "run_id": F.lit(run_id), "started_at": F.current_timestamp()})
        marks = ingest.high_waters(run).withColumns({"run_id": F.lit(run_id), "updated_at": F.current_timestamp()})
        store.append_log(run.select(*(c.split(" ")[0] for c in _LOGS["manifest"].split(", "))), f"{self.root}/state/manifest")
        store.append_log(marks.select(*(c.split(" ")[0] for c in _LOGS["watermarks"].split(", "))), f"{self.root}/state/watermarks")
        return self._log("manifest").where(F.col("run_id") == run_id)

    def raw_frame(self, provider: str, dataset: str, tickers: list[str] | None = None, runs: list[str] | None = None) -> DataFrame | None:
        """All raw payloads of a provider's dataset, or those of some runs; None if there are none."""
        path = f"{self.root}/raw/provider={provider}/dataset={dataset}"
        fs, where = store._fs(self.spark, path)
        if not fs.exists(where) or runs is not None and not runs:
            return None
        paths = [path] if runs is None else [f"{path}/run_id={r}" for r in runs]
        df = self.spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*paths)
        return df if tickers is None else df.where(F.upper("ticker").isin([t.upper() for t in tickers]))

    def latest_raw(self, provider: str, dataset: str, tickers: list[str] | None = None) -> DataFrame:
        """One provider's raw bars, the latest capture of each ticker and day."""
        df = self.raw_frame(provider, dataset, tickers)
        if df is None:
            raise ValueError(f"no raw {dataset} of {provider}")
        return dedupe.latest_wins(canonical_bars(df), ["ticker", "date"], "ingested_at", ["close", "volume"])

    def _write_text(self, name: str, text: str) -> str:
        path = f"{self.root}/reports/{name}.md"
        fs, where = store._fs(self.spark, path)
        stream = fs.create(where, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        return text

    def reconcile(self, a: str, b: str, dataset: str = "ohlcv_daily", tickers: list[str] | None = None, fields: tuple[str, ...] = (*PRICES, "volume")) -> str:
        """Two providers' raw bars field by field; rows and a text are kept, the text is given."""
        rows = tables.reconcile(self.latest_raw(a, dataset, tickers), self.latest_raw(b, dataset, tickers), list(fields), (a, b))
        run_id = uuid.uuid4().hex
        rows.withColumn("run_id", F.lit(run_id)).write.parquet(f"{self.root}/reconciliation/{run_id}")
        return self._write_text(f"reconciliation-{run_id}", reports.reconciliation_text(self.spark.read.parquet(f"{self.root}/reconciliation/{run_id}"), a, b))

    def validation_report(self, run_id: str) -> str:
        """Text of a run's flags, kept under reports."""
        flags = self.table("validation_flags").where(F.col("run_id") == run_id)
        return self._write_text(f"validation-{run_id}", reports.flags_text(detect.flag_summary(flags), detect.most_flagged(flags), run_id))

    def _promoted(self, provider: str, dataset: str, batch: DataFrame, number: int) -> None:
        """Notes what a batch of raw files held. Written after the batch's rows are in their table: a batch that is repeated is noted again under its number."""
        took = batch.groupBy("run_id").agg(F.count("*").alias("n"), F.countDistinct("__file").alias("f")).agg(F.array_sort(F.collect_list("run_id")).alias("run_ids"), F.sum("f").alias("files"), F.sum("n").alias("rows_read"))
        note = took.select(F.lit(provider).alias("provider"), F.lit(dataset).alias("dataset"), F.lit(number).cast("long").alias("batch"), "run_ids", "files", "rows_read", F.current_timestamp().alias("taken_at"))
        store.append_log(note, f"{self.root}/state/promotions")

    def promotions(self) -> DataFrame:
        """The ledger of promoted raw files, each batch as it was noted last."""
        return dedupe.latest_wins(self._log("promotions"), ["provider", "dataset", "batch"], "taken_at", ["rows_read"])

    def _raw_schema(self, path: str) -> str | None:
        fs, where = store._fs(self.spark, path)
        if not fs.exists(where):
            return None
        fields = self.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(path).schema.fields
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def curate(self, dataset: str, provider: str | None = None, files: int = 200) -> dict:
        """Raw payloads of a dataset that no earlier run took, at most `files` files a batch, into its tables; provider: of one vendor, None: of all, in the order of their names.

        The streams' checkpoints (one for each vendor, and for news one for each table) are the ledger of what was taken: files
        of earlier runs aren't opened again. A run that fails goes on with the batch that failed. Gives files, rows_read and batches; for news the
        rows that were put into `articles` and `tickers`, too.
        """
        took = {"files": 0, "rows_read": 0, "batches": 0}
        fs, where = store._fs(self.spark, f"{self.root}/raw/provider=*/dataset={dataset}")
        vendors_ = sorted(p.getParent().getName().split("=", 1)[1] for p in store._names(fs, where))
        for name in vendors_ if provider is None else [provider]:
            path, state = f"{self.root}/raw/provider={name}/dataset={dataset}", f"{self.root}/state/streams/{name}/{dataset}"
            if (schema := self._raw_schema(path)) is None:
                continue
            before = self.promotions().where((F.col("provider") == name) & (F.col("dataset") == dataset)).count()
            if dataset == "news":
                for table, counts in self._curate_news_stream(name, path, schema, state, files).items():
                    took[table] = {k: n + took.get(table, {}).get(k, 0) for k, n in counts.items()}
            else:
                put = self.curate_bars if dataset == "ohlcv_daily" else self.curate_actions

                def each(batch: DataFrame, number: int, name=name, put=put) -> None:
                    batch = batch.persist()
                    try:
                        put(batch.drop("__file").withColumn("source", F.lit(name)), f"{name}-{dataset}-{number:08d}")
                        self._promoted(name, dataset, batch, number)
                    finally:
                        batch.unpersist()

                self._files(path, schema, files).writeStream.foreachBatch(each).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
            fresh = self.promotions().where((F.col("provider") == name) & (F.col("dataset") == dataset) & (F.col("batch") >= before))
            sums = fresh.agg(F.sum("files").alias("files"), F.sum("rows_read").alias("rows_read"), F.count("*").alias("batches")).first()
            took |= {k: took[k] + (sums[k] or 0) for k in ("files", "rows_read", "batches")}
        return took

    def _files(self, path: str, schema: str, files: int) -> DataFrame:
        """A stream of raw files with run_id and __file from their paths."""
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(path)
        where = F.col("_metadata.file_path")
        return stream.withColumns({"run_id": F.regexp_extract(where, "/run_id=([^/]+)/", 1), "__file": where})

    def _curate_news_stream(self, provider: str, path: str, schema: str, state: str, files: int) -> dict[str, dict[str, int]]:
        """First captures of articles and of their tickers, by keyed state: no stored id is read. Gives what was put into each."""
        sums = {table: dict.fromkeys(("rows_in", "rows_new", "rows_replaced"), 0) for table in ("news_articles", "news_ticker_sentiment")}
        kinds = {"news_articles": (["article_id"], tables.ARTICLES, ["article_id", "published_at"]), "news_ticker_sentiment": (["article_id", "ticker"], tables.TICKER_SENTIMENT, ["article_id", "ticker"])}
        for table, (key, checks, required) in kinds.items():
            wanted = [c.split(" ")[0] for c in TABLES[table][0].split(", ") if c.split(" ")[0] != "year"]

            def put(batch: DataFrame, number: int, table=table, key=key, checks=checks, required=required) -> None:
                good = self._valid(batch, checks, key, required, table, f"{provider}-{table}-{number:08d}")
                for k, n in self._put(table, good, first=True).items():
                    sums[table][k] += n

            def prepare(stream: DataFrame, wanted=wanted) -> DataFrame:
                return stream.select(*(F.col(c) for c in wanted if c in stream.columns))

            first_capture.promote_first(self.spark, path, schema, "", f"{state}/{table}", key, "ingested_at", prepare, None, files, put)

        def note(batch: DataFrame, number: int) -> None:
            self._promoted(provider, "news", batch, number)

        narrow = self._files(path, schema, files).select("article_id", "run_id", "__file")
        narrow.writeStream.foreachBatch(note).option("checkpointLocation", f"{state}/ledger").trigger(availableNow=True).start().awaitTermination()
        return {"articles": sums["news_articles"], "tickers": sums["news_ticker_sentiment"]}

    def members(self, index_name: str, day) -> DataFrame:
        return tables.members_as_of(self.table("universe_membership"), day, index_name)

    def seed_universe(self, tickers: list[str], index_name: str, as_of, note: str = "static list of today's members: survivorship bias") -> dict[str, int]:
        """Opens memberships from a fixed list."""
        rows = self.spark.createDataFrame([(index_name, t.strip().upper()) for t in tickers], "index_name string, ticker string").distinct()
        return self._put("universe_membership", rows.withColumns({"effective_from": F.lit(as_of).cast("date"), "source": F.lit("seed"), "note": F.lit(note)}))

    def refresh_directory(self, lines: DataFrame, names: dict[str, str], as_of, index_name: str | None = None) -> DataFrame:
        """A listing directory's lines as a raw snapshot, a table of its rows and changes of rosters. index_name: all common stocks are its members; None: by exchange."""
        path = store.write_raw(lines, self.root, "directory", "listing", uuid.uuid4().hex)
        kept = self.spark.read.parquet(path)
        header = next(line for (line,) in kept.where(F.contains("value", F.lit("|")) & F.contains("value", F.lit("Security Name"))).limit(1).collect())
        rows = files.listing(kept, header, names)
        self._put("listing", rows.withColumns({"as_of": F.lit(as_of).cast("date"), "directory": F.lit(index_name or "other")}))
        target = files.rosters(rows) if index_name is None else tables.common_stocks(rows).select(F.lit(index_name).alias("index_name"), "ticker").distinct()
        return self.refresh_roster(target, as_of, "directory")

    def ingest_news(self, fetch_day, last, first, quota: int = 25, pages_a_day: int = 25, stream: str = "_FIREHOSE_") -> dict:
        """The news stream day by day after its watermark: fetch_day(day) -> (articles, whole). Empty days count as read; the first day that fails or isn't whole ends the run."""
        marks = tables.watermark_latest(self._log("watermarks")).where(F.col("ticker") == stream).select("high_water_date").first()
        days, much = ingest.day_plan(marks[0] if marks else pd.Timestamp(first) - pd.Timedelta(days=1), last, pages_a_day, quota)
        run_id, done, error, n = uuid.uuid4().hex, [], None, 0
        for day in days:
            try:
                items, whole = fetch_day(day)
                if not whole:
                    raise ValueError(f"more pages than allowed on {day}")
            except Exception as e:  # days after it stay to be read  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
                break
            if items:
                feed = self.spark.createDataFrame([(json.dumps(i),) for i in items], "item string").select(F.from_json("item", news.FEED).alias("i")).select("i.*")
                rows = dedupe.first_wins(news.parse_feed(feed, "firehose"), ["article_id", "ticker"], "published_at", ["title"])
                store.write_raw(rows.withColumn("ingested_at", F.current_timestamp()), self.root, "firehose", "news", f"{run_id}-{day}")
                n += len(items)
            done.append((day, "firehose", "news", stream))
        if done:
            marks = self.spark.createDataFrame(done[-1:], "high_water_date date, provider string, dataset string, ticker string").withColumns({"run_id": F.lit(run_id), "updated_at": F.current_timestamp()})
            store.append_log(marks.select(*(c.split(" ")[0] for c in _LOGS["watermarks"].split(", "))), f"{self.root}/state/watermarks")
        return {"days": len(done), "articles": n, "over_quota": much, "error": error}

    def stream_news(self, last, first, key: str = "", pages: int = 25, stream: str = "_FIREHOSE_") -> dict:
        """The news stream day by day after its watermark, read by tasks: transports.register first.

        A day is a batch of its own: its articles go to the raw folder and its watermark is noted, with articles or without. The
        first day that fails (or has more pages than allowed) ends the run; the days before it are kept, and the next run begins with it.
        """
        marks = tables.watermark_latest(self._log("watermarks")).where((F.col("ticker") == stream) & (F.col("dataset") == "news")).select("high_water_date").first()
        after = marks[0] if marks else (pd.Timestamp(first) - pd.Timedelta(days=1)).date()
        done = {"days": 0, "articles": 0, "error": None}

        def each(batch: DataFrame, number: int) -> None:
            batch = batch.persist()
            try:
                days = [r[0] for r in batch.where("item is null").select("day").distinct().orderBy("day").collect()]  # the days of one batch
                for day in days:
                    self._take_day(batch.where((F.col("day") == day) & F.col("item").isNotNull()), day, stream)
                done["days"] += len(days)
                done["articles"] += batch.where("item is not null").count()
            finally:
                batch.unpersist()

        source = self.spark.readStream.format("vendor_news").options(after=str(after), last=str(pd.Timestamp(last).date()), key=key, pages=str(pages)).load()
        query = source.writeStream.foreachBatch(each).option("checkpointLocation", f"{self.root}/state/streams/{stream}").start()
        try:
            query.processAllAvailable()
        except StreamingQueryException as e:  # what was read before stays, and is given with the error
            told = [line for line in str(e).splitlines() if re.match(r"\s*(?:\w+\.)*(?:ValueError|OSError|URLError|HTTPError|TimeoutError|KeyError|JSONDecodeError)\b", line)]
            done["error"] = (told[-1] if told else str(e).splitlines()[0]).strip()[:300]
        finally:
            query.stop()
        return done

    def _take_day(self, items: DataFrame, day, stream: str) -> None:
        feed = items.select(F.from_json("item", news.FEED).alias("i")).select("i.*")
        rows = dedupe.first_wins(news.parse_feed(feed, "firehose"), ["article_id", "ticker"], "published_at", ["title"]).withColumn("ingested_at", F.current_timestamp())
        # a folder for each day: a day that is taken again after a failure replaces what it wrote before
        path = f"{self.root}/raw/provider=firehose/dataset=news/run_id=day-{day}"
        rows.write.mode("overwrite").parquet(path)
        marks = self.spark.createDataFrame([(day, "firehose", "news", stream, f"day-{day}")], "high_water_date date, provider string, dataset string, ticker string, run_id string").withColumn("updated_at", F.current_timestamp())
        store.append_log(marks.select(*(c.split(" ")[0] for c in _LOGS["watermarks"].split(", "))), f"{self.root}/state/watermarks")

    def closes(self, first=None, last=None, tickers: list[str] | None = None) -> DataFrame:
        """(ticker, date, close): adjusted closes within the bounds."""
        self.views()
        return research.bounded(self.spark.table("ohlcv_daily_adj").select("ticker", "date", "close"), first, last, tickers)

    def research(self, start=None, end=None) -> str:
        """Information coefficients and an event study of sentiment; closes go on beyond `end`, which bounds the factor alone."""
        factor = research.bounded(self.table("sentiment_daily"), start, end)
        score = "sent_finbert" if factor.where("sent_finbert is not null").limit(1).count() else "sent_av"
        closes = self.closes(start)
        sizes = research.sample_sizes(factor.where(F.col(score).isNotNull()))
        text = reports.research_text(research.ic_decay(factor, closes, score), research.event_study(closes, research.find_events(factor, score, 0.35)), f"Sentiment ({score})")
        return self._write_text(f"research-{uuid.uuid4().hex}", f"{text}\n{reports.table(sizes)}\n")

    def basket(self, names: list[str]) -> str:
        """Metrics of the names that have bars, with their latest sentiment."""
        days = research.bounded(self.table("sentiment_daily"), tickers=names)
        latest = research.latest(days, "ticker", "date", ["sent_av", "n_articles"]).withColumnRenamed("date", "sentiment_date")
        return reports.basket_text(research.basket_metrics(self.closes(), names), latest)

    def one_pager(self, ticker: str) -> str:
        text = reports.one_pager(ticker, research.momentum(self.closes(tickers=[ticker])), self.table("fundamentals_snapshot"), self.table("sentiment_daily"))
        return self._write_text(f"one-pager-{ticker}", text)

    def export(self, sql: str, path: str) -> str:
        """A gated query's whole result as parquet or, by another ending, as CSV with a header."""
        df = self.spark.sql(gate.guard(self.spark, sql, set(self.views())))
        if path.endswith(".parquet"):
            df.write.mode("overwrite").parquet(path)
        else:
            df.write.mode("overwrite").csv(path, header=True)
        return path

    def failures(self, run_id: str) -> DataFrame:
        return self._log("manifest").where((F.col("run_id") == run_id) & (F.col("status") != "ok"))

    def status(self) -> dict[str, DataFrame]:
        """Watermarks by provider and dataset, the latest runs, and counts of flags."""
        marks = tables.watermark_latest(self._log("watermarks")).groupBy("provider", "dataset").agg(F.count("*").alias("tickers"), F.min("high_water_date").alias("oldest"), F.max("high_water_date").alias("newest"))
        return {"watermarks": marks, "runs": tables.run_rollup(self._log("manifest")), "flags": detect.flag_summary(self.table("validation_flags"))}

    def query(self, sql: str) -> str:
        return gate.run_sql(self.spark, sql, views=set(self.views()))
