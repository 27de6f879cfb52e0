"""A read-only SQL gate over registered views, a description of their columns, and checks of cited figures."""

from __future__ import annotations

import threading
import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.tables import ghosts

#: Plan nodes that only read. A node that isn't here is rejected, so new commands of later Spark versions are too.
READS = {
    "Aggregate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation",
    "Pivot", "Project", "Sample", "Sort", "SubqueryAlias", "Union", "UnresolvedHaving", "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedWith", "Unpivot", "UnresolvedTVFAliases", "UnresolvedTableValuedFunction", "Window", "WithWindowDefinition",
}
#: Functions that run foreign code.
NO_CALLS = {"java_method", "reflect", "try_reflect"}
#: Functions in FROM that make rows out of their arguments alone.
ROW_MAKERS = {"explode", "explode_outer", "inline", "inline_outer", "posexplode", "posexplode_outer", "range", "stack"}


class Rejected(ValueError):
    """Not a single reading statement over known views."""


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _name(parts) -> list[str]:
    return [str(p) for p in _items(parts)]


def guard(spark: SparkSession, sql: str, views: set[str] | None = None) -> str:
    """sql without a closing semicolon, or Rejected. Literals and aliases may hold any word, since the parsed plan is judged, not the text.

    views: names that may be read (None: the session's temporary views). Names of common table expressions may be read as well.
    """
    text = sql.strip().removesuffix(";").rstrip()
    if not text:
        raise Rejected("empty statement")
    known = {v.lower() for v in (views if views is not None else {t.name for t in spark.catalog.listTables() if t.isTemporary})}
    try:
        # what stands where a plan stands is judged as one, whatever package its class is in
        todo = [(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), frozenset(), True)]
    except PySparkException as e:
        raise Rejected(f"no single statement of SQL: {str(e).splitlines()[0]}") from e
    while todo:
        node, own, is_plan = todo.pop()
        kind = node.getClass().getSimpleName()
        if is_plan and kind not in READS:
            raise Rejected(f"only reading queries are allowed, not {kind}")
        if kind == "UnresolvedWith":
            names = [str(r._1()).lower() for r in _items(node.cteRelations())]
            own = own | frozenset(names)
            todo += [(r._2(), own, True) for r in _items(node.cteRelations())]
        elif kind == "UnresolvedRelation":
            parts = _name(node.multipartIdentifier())
            if len(parts) != 1 or parts[0].lower() not in known | own:
                raise Rejected(f"unknown view: {'.'.join(parts)}")
        elif kind == "UnresolvedFunction" and _name(node.nameParts())[-1].lower() in NO_CALLS:
            raise Rejected(f"function not allowed: {_name(node.nameParts())[-1]}")
        elif kind == "UnresolvedTableValuedFunction" and _name(node.name())[-1].lower() not in ROW_MAKERS:
            raise Rejected(f"function not allowed in FROM: {_name(node.name())[-1]}")
        elif kind in ("UnresolvedGenerator",) and str(node.name().funcName()).lower() in NO_CALLS:
            raise Rejected(f"function not allowed: {node.name().funcName()}")
        elif not is_plan and "UnresolvedIdentifier" in kind:
            raise Rejected("IDENTIFIER is not allowed")
        if not is_plan and (kind in ("Exists", "ListQuery") or "Subquery" in kind and kind != "InSubquery"):
            todo.append((node.plan(), own, True))
        todo += [(c, own, is_plan) for c in _items(node.children())]
        if is_plan:
            todo += [(e, own, False) for e in _items(node.expressions().toIndexedSeq())]
            if kind == "LateralJoin":
                todo.append((node.right().plan(), own, True))
    return text


def rendered(df: DataFrame, rows: int = 50, cols: int = 20) -> str:
    """A pipe table of at most so many rows and columns, and a line that says what was cut."""
    names = df.columns[:cols]
    found = df.toDF(*(f"c{i}" for i in range(len(df.columns)))).select(*(f"c{i}" for i in range(len(names)))).limit(rows + 1).collect()
    lines = [" | ".join(names)] + [" | ".join("" if v is None else str(v) for v in r) for r in found[:rows]]
    if len(found) > rows:
        lines.append(f"(first {rows} rows only)")
    if len(df.columns) > cols:
        lines.append(f"(first {cols} of {len(df.columns)} columns)")
    return "\n".join(lines if found else [*lines, "(no rows)"])


def run_sql(spark: SparkSession, sql: str, rows: int = 50, cols: int = 20, seconds: float = 15.0, views: set[str] | None = None) -> str:
    """The query's result as text; what the gate refuses starts with REJECTED:, what Spark refuses or a timer ends with SQL ERROR:."""
    try:
        text = guard(spark, sql, views)
    except Rejected as e:
        return f"REJECTED: {e}"
    sc, group, late = spark.sparkContext, f"gate-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        sc.cancelJobGroup(group)

    timer = threading.Timer(seconds, stop)
    sc.setJobGroup(group, "gated query", interruptOnCancel=True)
    timer.start()
    try:
        return rendered(spark.sql(text), rows, cols)
    except Exception as e:  # any failure of the query is an answer to its author  # noqa: BLE001
        return f"SQL ERROR: stopped after {seconds:g} s" if late.is_set() else f"SQL ERROR: {str(e).splitlines()[0]}"
    finally:
        timer.cancel()
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(key, None)


def examples(df: DataFrame, columns: list[str] | None = None, chars: int = 24) -> DataFrame:
    """(column, type, example_1, example_2): the two smallest distinct values of each column, in two passes over df whatever the number of columns."""
    names = columns if columns is not None else [c for c, t in df.dtypes if not t.startswith("map")]
    types = dict(df.dtypes)
    flat = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    least = flat.agg(*(F.min(f"c{i}").alias(f"m{i}") for i in range(len(names))))
    both = flat.crossJoin(F.broadcast(least)).agg(*(F.first(f"m{i}").alias(f"m{i}") for i in range(len(names))), *(F.min(F.when(F.col(f"c{i}") > F.col(f"m{i}"), F.col(f"c{i}"))).alias(f"n{i}") for i in range(len(names))))
    short = lambda c: F.substr(F.col(c).cast("string"), F.lit(1), F.lit(chars))
    return both.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), short(f"m{i}").alias("example_1"), short(f"n{i}").alias("example_2")) for i, c in enumerate(names)))))


def schema_context(views: dict[str, DataFrame], columns: int = 60) -> str:
    """Views by name with their columns, types and examples; the same text for the same data."""
    out = []
    for name in sorted(views):
        df = views[name]
        names = [c for c, t in df.dtypes if not t.startswith("map")][:columns]
        out.append(f"## {name}")
        out += [f"- {r.column}: {r.type}" + (f" (e.g. {', '.join(x for x in (r.example_1, r.example_2) if x is not None)})" if r.example_1 is not None else "") for r in examples(df, names).collect()]
        if len(df.columns) > len(names):
            out.append(f"- and {len(df.columns) - len(names)} more")
    return "\n".join(out)


def spot_check(cited: DataFrame, facts: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(ticker, column, value, actual, ok) for each cited figure (ticker, column, value) that facts, one row a ticker, hold as a number."""
    types = dict(facts.dtypes)
    names = [r[0] for r in cited.select("column").distinct().collect() if r[0] in types and r[0] != "ticker"]
    if not names:
        return cited.select("ticker", "column", "value", F.lit(None).cast("double").alias("actual"), F.lit(None).cast("boolean").alias("ok")).where("false")
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").try_cast("double").alias("actual")) for c in names))
    real = facts.select("ticker", F.inline(cells)).where("actual is not null")
    got = cited.where("value is not null").withColumn("ticker", F.upper("ticker")).join(real, ["ticker", "column"])
    return got.select("ticker", "column", "value", "actual", (F.abs(F.col("actual") - F.col("value")) <= F.greatest(F.abs("actual") * tolerance, F.lit(1e-9))).alias("ok"))


def verify_proposal(cited: DataFrame, views: dict[str, DataFrame], sector_cap: float = 0.40, least: int = 5) -> DataFrame:
    """(check, passed, detail) for a proposal (ticker, view, column, value), one row a cited figure; facts in views['fundamentals_snapshot'], rosters in views['universe_membership'].

    A check without anything to look at has no row. The sector cap holds for books of at least `least` names.
    """
    spark, rows = cited.sparkSession, []
    facts = views.get("fundamentals_snapshot")
    book = cited.select(F.upper("ticker").alias("ticker")).distinct()
    n = book.count()
    known = [views[v] for v in ("fundamentals_snapshot", "universe_membership") if v in views]
    if known and reduce(lambda a, b: a.union(b), (k.select("ticker") for k in known)).limit(1).count():
        unknown = [r[0] for r in ghosts(book, *known).orderBy("ticker").limit(20).collect()]
        rows.append(("tickers_exist", not unknown, ", ".join(unknown)))
    if facts is not None and n >= least and "sector" in facts.columns:
        top = facts.join(F.broadcast(book) if n <= 10_000 else book, "ticker", "left_semi").where("sector <> ''").groupBy("sector").agg(F.countDistinct("ticker").alias("n")).orderBy(F.desc("n"), "sector").first()
        if top:
            rows.append(("sector_share", top.n <= sector_cap * n, f"{top.sector}: {top.n} of {n}"))
    cites = cited.select("view", "column").distinct().orderBy("view", "column").collect()
    bad = [f"{r.view}.{r.column}" for r in cites if r.view not in views or r.column not in views[r.view].columns]
    rows.append(("columns_exist", not bad, ", ".join(bad)))
    if facts is not None:
        got = spot_check(cited.where("view = 'fundamentals_snapshot'").select("ticker", "column", F.col("value").try_cast("double").alias("value")), facts)
        sums = got.agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("off")).first()
        if sums.n:
            rows.append(("figures", sums.off == 0, f"{sums.n - sums.off} of {sums.n} within the tolerance"))
    return spark.createDataFrame(rows, "check string, passed boolean, detail string")
