"""Files that vendors publish: pipe-delimited listing directories and screener exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.dedupe import first_row_wins
from ledgerline.operators.tables import common_stocks

#: Headers of the directories and our names for them.
NASDAQ = {
    "Symbol": "ticker", "Security Name": "security_name", "Market Category": "market_category", "Test Issue": "test_issue",
    "Financial Status": "financial_status", "Round Lot Size": "round_lot_size", "ETF": "etf", "NextShares": "nextshares",
}
OTHER = {
    "ACT Symbol": "ticker", "Security Name": "security_name", "Exchange": "exchange", "CQS Symbol": "cqs_symbol",
    "ETF": "etf", "Round Lot Size": "round_lot_size", "Test Issue": "test_issue", "NASDAQ Symbol": "nasdaq_symbol",
}
#: Exchange code and the roster it feeds.
ROSTERS = {"N": "NYSE", "P": "ARCA", "A": "AMEX", "Z": "CBOE"}
FOOTER = "File Creation Time"


def listing(lines: DataFrame, header: str, names: dict[str, str], text: str = "value") -> DataFrame:
    """Rows of a pipe-delimited directory. lines: one row a line, as spark.read.text gives them; header: its first line.

    A header other than `names` is an error. Blank lines, the header and the footer go; cells are trimmed, a round lot that
    is no number is null. The ticker NA stays text.
    """
    found = [h.strip() for h in header.split("|")]
    if set(found) != set(names):
        raise ValueError(f"the directory's columns have changed: {sorted(set(found) ^ set(names))}")
    line = F.col(text)
    body = lines.where((F.trim(line) != "") & ~F.startswith(line, F.lit(FOOTER)) & (F.rtrim(line) != header.rstrip()))
    cells = body.select(F.split(line, r"\|").alias("__cells"))
    at = {names[h]: F.trim(F.get("__cells", F.lit(i))) for i, h in enumerate(found)}
    at["round_lot_size"] = at["round_lot_size"].try_cast("double")
    return cells.select(*(at[c].alias(c) for c in names.values()))


def read_listing(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """A directory file or folder of them; the header is read from its first line that isn't blank."""
    lines = spark.read.text(path)
    first = lines.where(F.trim("value") != "").first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return listing(lines, first[0], names)


def rosters(others: DataFrame) -> DataFrame:
    """(index_name, ticker): common stocks of the other-listed directory, which gives no financial status, by the roster of their exchange; other exchanges go."""
    name = F.create_map(*(F.lit(x) for kv in ROSTERS.items() for x in kv))[F.col("exchange")]
    return common_stocks(others, statuses=None).select(name.alias("index_name"), "ticker").where("index_name is not null").distinct()


def screener(raw: DataFrame, as_of, note: str = "") -> DataFrame:
    """A fundamentals snapshot from an export read as text columns: ticker first, then the export's columns, as_of and note. The first row of a ticker in the file stays."""
    by_lower = {c.lower(): c for c in raw.columns}
    if "symbol" not in by_lower:
        raise ValueError("the export has no column 'symbol'")
    symbol = by_lower["symbol"]
    rest = [F.col(f"`{c}`") for c in raw.columns if c != symbol]
    rows = raw.select(F.upper(F.trim(F.col(f"`{symbol}`"))).alias("ticker"), *rest).where("ticker is not null and ticker <> ''")
    return first_row_wins(rows, ["ticker"]).withColumns({"as_of": F.lit(as_of).cast("date"), "note": F.lit(note)})


def read_screener(spark: SparkSession, path: str, as_of, note: str = "") -> DataFrame:
    return screener(spark.read.csv(path, header=True, inferSchema=False, multiLine=False), as_of, note)
