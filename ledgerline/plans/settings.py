"""Defaults of the jobs, in one place that nothing changes."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from datetime import date

#: Names under which a dataset may be asked for.
DATASETS = {"ohlcv": "ohlcv_daily", "ohlcv_daily": "ohlcv_daily", "bars": "ohlcv_daily", "actions": "corporate_actions", "corporate_actions": "corporate_actions", "news": "news", "fundamentals": "fundamentals_snapshot"}


@dataclass(frozen=True)
class Settings:
    root: str = "lake"
    provider: str = "synthetic"
    calendar: str = "XNYS"
    index_name: str = "NASDAQ"
    first_day: date = date(2015, 1, 1)
    tickers_a_batch: int = 200
    requests_per_minute: float = 60.0
    mad_window: int = 63
    mad_threshold: float = 8.0
    stale_run: int = 5
    zero_run: int = 3
    gap: float = 0.30
    price_tolerance: float = 0.005
    volume_tolerance: float = 0.10
    pages_a_day: int = 25
    requests_a_day: int = 25
    query_seconds: float = 15.0
    query_rows: int = 50
    query_columns: int = 20


def dataset(name: str) -> str:
    if name.lower() not in DATASETS:
        raise ValueError(f"unknown dataset {name}; known: {sorted(DATASETS)}")
    return DATASETS[name.lower()]


def from_environment(base: Settings = Settings(), prefix: str = "LEDGERLINE_") -> Settings:
    """base with the fields that the environment names, as LEDGERLINE_ROOT."""
    given = {}
    for f in fields(base):
        text = os.environ.get(prefix + f.name.upper())
        if text is not None:
            kind = type(getattr(base, f.name))
            given[f.name] = date.fromisoformat(text) if kind is date else kind(text)
    return replace(base, **given)
