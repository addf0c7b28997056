"""Run windows: which days a daily or yearly run covers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = ("daily", "yearly")


@dataclass(frozen=True)
class RunWindow:
    """Inclusive day range [lo, hi]."""

    lo: dt.date
    hi: dt.date

    def days(self) -> int:
        return (self.hi - self.lo).days + 1


def _day(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


def run_window(period: str, start, end=None, lag_days: int = 0, half_open: bool = False) -> RunWindow:
    """``daily``: the start day; ``yearly``: start day .. end day, end inclusive
    (``half_open`` drops the end day). ``lag_days`` shifts a daily window back
    (the land-surface feed runs one day behind). Anything else is an error."""
    if period == "daily":
        d = _day(start) - dt.timedelta(days=lag_days)
        return RunWindow(d, d)
    if period == "yearly":
        if end is None:
            raise ValueError("yearly window needs an end")
        lo, hi = _day(start), _day(end)
        if half_open:
            hi = hi - dt.timedelta(days=1)
        if hi < lo:
            raise ValueError(f"empty window {lo}..{hi}")
        return RunWindow(lo, hi)
    raise ValueError(f"no run window for period {period!r}; one of {', '.join(PERIODS)} is needed")


def in_window(c: str | Column, w: RunWindow) -> Column:
    """Predicate on a date or timestamp column, as a half-open range so that it
    stays a plain comparison (pushed to the Parquet scan / partition pruning)."""
    col = F.col(c) if isinstance(c, str) else c
    return (col >= F.lit(w.lo)) & (col < F.lit(w.hi + dt.timedelta(days=1)))
