"""Short texts from small results."""

from __future__ import annotations

from pyspark.sql import DataFrame

CAVEATS = "Measured on today's members and on adjusted closes; descriptive, no advice."


def _cell(value, digits: int = 4) -> str:
    return "N/A" if value is None else f"{value:.{digits}f}" if isinstance(value, float) else str(value)


def table(df: DataFrame, rows: int = 200, digits: int = 4) -> str:
    """A markdown table of the first rows, in the frame's order."""
    found = df.limit(rows).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(_cell(v, digits) for v in r) + " |" for r in found])


def flags_text(summary: DataFrame, worst: DataFrame, run_id: str) -> str:
    """summary: counts by type and severity; worst: the most flagged tickers."""
    return f"# Validation {run_id}\n\n{table(summary.orderBy('flag_type', 'severity'))}\n\n## Most flagged\n\n{table(worst)}\n"


def reconciliation_text(rows: DataFrame, a: str, b: str) -> str:
    counts = rows.groupBy("classification").count().orderBy("count", ascending=False)
    return f"# {a} against {b}\n\n{table(counts)}\n\n{table(rows.groupBy('ticker', 'classification').count().orderBy('ticker', 'classification'))}\n"


def research_text(decay: DataFrame, car: DataFrame, title: str = "Sentiment") -> str:
    return f"# {title}\n\n## Information coefficients\n\n{table(decay.orderBy('horizon'))}\n\n## Cumulative abnormal returns\n\n{table(car.orderBy('sign', 'offset'))}\n\n{CAVEATS}\n"


def basket_text(metrics: DataFrame, sentiment: DataFrame | None = None) -> str:
    """A table of all metrics by ticker, with each ticker's latest sentiment if there is one."""
    rows = metrics if sentiment is None else metrics.join(sentiment, "ticker", "left")
    return f"{table(rows.orderBy('ticker'))}\n\n{CAVEATS}\n"


def one_pager(ticker: str, momentum: DataFrame, facts: DataFrame, sentiment: DataFrame) -> str:
    """A ticker's momentum, its latest facts (as_of) and its last five days of sentiment."""
    row = facts.where(facts["ticker"] == ticker).orderBy("as_of", ascending=False).limit(1)
    days = sentiment.where(sentiment["ticker"] == ticker).orderBy("date", ascending=False).limit(5)
    return f"# {ticker}\n\n## Momentum\n\n{table(momentum.where(momentum['ticker'] == ticker))}\n\n## Facts\n\n{table(row)}\n\n## Sentiment\n\n{table(days)}\n\n{CAVEATS}\n"
