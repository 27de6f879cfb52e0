"""Seeded bars as a Python data source, and events that are worked into bars with column operations."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerline.functions.calendar import session_days

SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume long"


class Batch(InputPartition):
    def __init__(self, tickers: list[str]):
        self.tickers = tickers


class BarsReader(DataSourceReader):
    """Geometric random walks over sessions; a ticker's path depends on its name and the seed alone."""

    def __init__(self, options: dict[str, str]):
        self.tickers = [t.strip().upper() for t in options["tickers"].split(",") if t.strip()]
        self.first, self.last = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])
        self.seed, self.size = int(options.get("seed", "7")), int(options.get("batch", "200"))

    def partitions(self) -> list[Batch]:
        return [Batch(self.tickers[i : i + self.size]) for i in range(0, len(self.tickers), self.size)] or [Batch([])]

    def read(self, partition: Batch) -> Iterator[pa.RecordBatch]:
        days = session_days(self.first, self.last)
        for ticker in partition.tickers:
            draw = np.random.default_rng(zlib.crc32(ticker.encode()) ^ self.seed)
            close = 50 * np.exp(draw.normal(0.0003, 0.015, len(days)).cumsum())
            open_ = close * np.exp(draw.normal(0, 0.004, len(days)))
            wick = np.abs(draw.normal(0, 0.004, (2, len(days))))
            high, low = np.maximum(open_, close) * (1 + wick[0]), np.minimum(open_, close) * (1 - wick[1])
            volume = draw.integers(100_000, 5_000_000, len(days))
            cells = [pa.array([ticker] * len(days), pa.string()), pa.array(days, pa.date32()), *(pa.array(x) for x in (open_, high, low, close)), pa.array(volume, pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, names=["ticker", "date", "open", "high", "low", "close", "volume"])


class SyntheticBars(DataSource):
    """spark.read.format("synthetic_bars").options(tickers="A,B", start="2020-01-01", end="2020-12-31", seed=7).load()"""

    @classmethod
    def name(cls) -> str:
        return "synthetic_bars"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BarsReader:
        return BarsReader(dict(self.options))


#: Sources that register() makes known; vendors' transports are added by their users.
REGISTRY: dict[str, type[DataSource]] = {"synthetic_bars": SyntheticBars}


def register(spark, name: str = "synthetic_bars") -> None:
    if name not in REGISTRY:
        raise KeyError(f"unknown source {name}; known: {sorted(REGISTRY)}")
    for module in {REGISTRY[name].__module__, session_days.__module__}:
        cloudpickle.register_pickle_by_value(sys.modules[module])  # workers need not have this package installed
    spark.dataSource.register(REGISTRY[name])


def _scaled(bars: DataFrame, where: Column, price: Column, volume: Column | None = None) -> DataFrame:
    out = bars.withColumns({c: F.when(where, F.col(c) * price).otherwise(F.col(c)) for c in ("open", "high", "low", "close")})
    return out if volume is None else out.withColumn("volume", F.when(where, F.round(F.col("volume") * volume).cast("long")).otherwise(F.col("volume")))


def with_gap(bars: DataFrame, on: str, pct: float) -> DataFrame:
    """All prices from `on` onwards times 1 + pct."""
    return _scaled(bars, F.col("date") >= F.lit(on).cast("date"), F.lit(1 + pct))


def with_split(bars: DataFrame, ex_date: str, ratio: float) -> DataFrame:
    """As traded: from the ex-date on prices are divided by the ratio and volumes multiplied."""
    return _scaled(bars, F.col("date") >= F.lit(ex_date).cast("date"), F.lit(1 / ratio), F.lit(ratio))


def with_dividend(bars: DataFrame, ex_date: str, amount: float) -> DataFrame:
    """Prices from the ex-date on fall in the ratio by which the amount lowers the close before it."""
    day = F.lit(ex_date).cast("date")
    before = F.max_by(F.when(F.col("date") < day, F.col("close")), F.when(F.col("date") < day, F.col("date"))).over(Window.partitionBy("ticker"))
    cut = F.greatest(F.lit(0.0), 1 - F.lit(amount) / before)
    return _scaled(bars.withColumn("__cut", F.coalesce(cut, F.lit(1.0))), F.col("date") >= day, F.col("__cut")).drop("__cut")


def _in_run(start: str, length: int) -> Column:
    """The sessions of a ticker from `start` on, `length` of them."""
    order = Window.partitionBy("ticker").orderBy("date")
    at = F.sum((F.col("date") >= F.lit(start).cast("date")).cast("int")).over(order)
    return at.between(1, length)


def with_stale_run(bars: DataFrame, start: str, length: int) -> DataFrame:
    """The first close of the run stands for all prices in it."""
    held = F.first(F.when(F.col("__run"), F.col("close")), ignorenulls=True).over(Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    marked = bars.withColumn("__run", _in_run(start, length)).withColumn("__held", held)
    return marked.withColumns({c: F.when(F.col("__run"), F.col("__held")).otherwise(F.col(c)) for c in ("open", "high", "low", "close")}).drop("__run", "__held")


def with_zero_volume(bars: DataFrame, start: str, length: int) -> DataFrame:
    return bars.withColumn("__run", _in_run(start, length)).withColumn("volume", F.when(F.col("__run"), F.lit(0).cast("long")).otherwise(F.col("volume"))).drop("__run")


def without_sessions(bars: DataFrame, days: list[str]) -> DataFrame:
    return bars.where(~F.col("date").isin(*(date.fromisoformat(d) for d in days))) if days else bars
