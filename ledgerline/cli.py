"""The lake's commands: python -m ledgerline.cli <command> ..."""

from __future__ import annotations

import argparse
import importlib
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calendar
from ledgerline.operators import dedupe, news, reports
from ledgerline.operators import ingest as ingest_rows
from ledgerline.plans import settings as defaults
from ledgerline.plans.jobs import Lake
from ledgerline.sources import files, synthetic, transports


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("--root")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple, **kw):
        c = sub.add_parser(name, **kw)
        for flag, more in options:
            c.add_argument(flag, **more)
        return c

    day = lambda flag, **kw: (flag, {"type": date.fromisoformat, **kw})
    text = lambda flag, **kw: (flag, kw)
    command("init")
    command("seed", text("tickers"), day("--as-of", required=True), text("--index"))
    command("refresh", text("--file"), day("--as-of", required=True), text("--index"))
    command("refresh-other", text("--file"), day("--as-of", required=True))
    command("ingest", text("dataset"), text("--tickers"), text("--index"), text("--provider"), day("--start"), day("--end", required=True))
    command("curate", text("dataset"), text("--provider"))
    command("validate")
    command("update", text("--tickers"), text("--index"), text("--provider"), day("--end", required=True))
    command("news", text("step", choices=["ingest", "curate", "score", "build", "update"]), text("--key", default=""), text("--scorer"), text("--revision", default="1"), day("--end"))
    command("security-master", text("file"), day("--as-of", required=True))
    command("fundamentals", text("file"), day("--as-of", required=True), text("--note", default=""))
    command("reconcile", text("a"), text("b"), text("--dataset", default="ohlcv_daily"), text("--tickers"))
    command("query", text("sql"), text("--out"))
    command("status")
    command("research", text("step", choices=["sentiment", "basket"]), text("--tickers"), day("--start"), day("--end"))
    command("one-pager", text("ticker"))
    return p


def tickers_of(lake: Lake, given: str | None, index_name: str | None, day: date | None = None) -> list[str]:
    """Tickers named, or the members of an index on a day."""
    if given:
        return sorted({t.strip().upper() for t in given.split(",") if t.strip()})
    if not index_name:
        raise SystemExit("give --tickers or --index")
    return [r[0] for r in lake.members(index_name, day or date.today()).orderBy("ticker").collect()]


def _fetch(spark: SparkSession, provider: str, dataset: str):
    """plan -> payload of a provider."""
    if provider == "synthetic":
        synthetic.register(spark)

        def fetch(plan: DataFrame) -> DataFrame:
            asked = plan.collect()  # a batch's tickers
            bars = spark.read.format("synthetic_bars").options(tickers=",".join(r.ticker for r in asked), start=str(min(r.start for r in asked)), end=str(max(r.end for r in asked))).load()
            return bars if dataset == "ohlcv_daily" else spark.createDataFrame([], "ticker string, ex_date date, action_type string, value double")

        return fetch
    transports.register(spark)
    return lambda plan: transports.history(spark, plan, dataset)


def _news(spark: SparkSession, lake: Lake, a: argparse.Namespace, s: defaults.Settings, out) -> None:
    """One step of the news, or for `update` all of them in order; scoring is left out of an update that names no scorer."""
    steps = ["ingest", "curate", *(["score"] if a.scorer else []), "build"] if a.step == "update" else [a.step]
    for step in steps:
        if step == "ingest":
            transports.register(spark)
            out(str(lake.stream_news(a.end or date.today(), s.first_day, a.key, s.pages_a_day)))
        elif step == "curate":
            out(str(lake.curate("news")))
        elif step == "score":
            if not a.scorer or ":" not in a.scorer:
                raise SystemExit("give --scorer module:function; the function returns a model that takes a list of texts")
            module, name = a.scorer.split(":", 1)
            out(str(lake.score_news(ingest_rows.scorer(getattr(importlib.import_module(module), name)), a.revision)))
        else:
            markets = sorted({s.calendar, news.DEFAULT_MARKET[1], *(m[2] for m in news.MARKETS)})
            out(str(lake.build_sentiment(calendar.calendar_map(calendar.sessions(spark, markets)))))


def run(spark: SparkSession, argv: list[str], out=print) -> None:
    a = _parser().parse_args(argv)
    s = defaults.from_environment()
    lake = Lake(spark, a.root or s.root, calendar.sessions(spark, s.calendar))
    days = lambda: calendar.calendar_map(lake.sessions)
    index = getattr(a, "index", None) or s.index_name

    def ingest(dataset: str, start: date | None) -> None:
        names = tickers_of(lake, a.tickers, a.index, a.end)
        provider = a.provider or s.provider
        wanted = spark.createDataFrame([(provider, dataset, t) for t in names], "provider string, dataset string, ticker string")
        got = lake.ingest(provider, dataset, _fetch(spark, provider, dataset), wanted, days(), start or s.first_day, a.end, s.tickers_a_batch)
        out(reports.table(got.groupBy("status").count()))
        out(reports.table(got.where("status <> 'ok'").select("ticker", "error").limit(10)))

    if a.command == "init":
        out("\n".join(lake.views()))
    elif a.command == "seed":
        out(str(lake.seed_universe(a.tickers.split(","), index, a.as_of)))
    elif a.command == "refresh":
        lines = spark.read.text(a.file) if a.file else transports.directory(spark, "nasdaq_listed")
        out(reports.table(lake.refresh_directory(lines, files.NASDAQ, a.as_of, index).groupBy("change").count()))
    elif a.command == "refresh-other":
        lines = spark.read.text(a.file) if a.file else transports.directory(spark, "other_listed")
        out(reports.table(lake.refresh_directory(lines, files.OTHER, a.as_of).groupBy("index_name", "change").count()))
    elif a.command == "ingest":
        ingest(defaults.dataset(a.dataset), a.start)
    elif a.command == "curate":
        out(str(lake.curate(defaults.dataset(a.dataset), a.provider)))
    elif a.command == "validate":
        lake.validate(run_id="full")
        out(lake.validation_report("full"))
    elif a.command == "update":
        for dataset in ("corporate_actions", "ohlcv_daily"):
            ingest(dataset, None)
            out(str(lake.curate(dataset, a.provider or s.provider)))
    elif a.command == "news":
        _news(spark, lake, a, s, out)
    elif a.command == "security-master":
        rows = spark.read.parquet(a.file) if a.file.endswith(".parquet") else spark.read.csv(a.file, header=True)
        fields = ["exchange", "gic_sector", "gic_group", "gic_industry", "gic_sub_industry"]
        known = rows.select(F.upper(F.trim("ticker")).alias("ticker"), *((F.coalesce(F.trim(c), F.lit("")) if c in rows.columns else F.lit("")).alias(c) for c in fields))
        out(str(lake.refresh_master(dedupe.latest_wins(known, ["ticker"], fields[0], fields[1:]), a.as_of)))
    elif a.command == "fundamentals":
        out(str(lake.take_fundamentals(spark.read.csv(a.file, header=True), a.as_of, a.note)))
    elif a.command == "reconcile":
        out(lake.reconcile(a.a, a.b, a.dataset, a.tickers.split(",") if a.tickers else None))
    elif a.command == "query":
        out(lake.export(a.sql, a.out) if a.out else lake.query(a.sql))
    elif a.command == "status":
        for name, df in lake.status().items():
            out(f"## {name}\n\n{reports.table(df)}")
    elif a.command == "research":
        out(lake.research(a.start) if a.step == "sentiment" else lake.basket(tickers_of(lake, a.tickers, None)))
    else:
        out(lake.one_pager(a.ticker.upper()))


def main() -> None:
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
