"""One row for each key, in a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_wins(df: DataFrame, keys: list[str], by: str, ties: list[str] = ()) -> DataFrame:
    """The row with the largest `by` for each key; nulls are equal keys; ties go to the largest of `ties`."""
    return _pick(df, keys, [F.col(by).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in ties)])


def first_wins(df: DataFrame, keys: list[str], by: str, ties: list[str] = ()) -> DataFrame:
    return _pick(df, keys, [F.col(by).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)])


def first_row_wins(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row that stands first, by file name and then by place in the file: only for a frame just read, whose ids ascend within each file."""
    placed = df.withColumns({"__file": F.input_file_name(), "__id": F.monotonically_increasing_id()})
    return first_wins(placed, keys, "__file", ["__id"]).drop("__file", "__id")


def total_order(df: DataFrame, keys: list[str], first: str | None = None) -> list[str]:
    """Columns that settle which of several rows with one key stays: `first`, then all others that can be ordered."""
    rest = [f.name for f in df.schema.fields if f.name not in (*keys, first) and f.dataType.typeName() not in ("map", "variant")]
    return [*([first] if first else []), *rest]
