"""Date/time column helpers (all JVM-side, UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def step_times(start_s: str | Column, end_s: str | Column, step_s: str | Column) -> Column:
    """Timestamps start, start+step, ... strictly before end (left-closed range)."""
    start, end, step = _c(start_s), _c(end_s), _c(step_s)
    n = F.greatest(F.ceil((end - start) / step).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.timestamp_seconds(start + i * step))


def expected_steps(start_s: str | Column, end_s: str | Column, step_s: str | Column) -> Column:
    start, end, step = _c(start_s), _c(end_s), _c(step_s)
    return F.greatest(F.ceil((end - start) / step).cast("int"), F.lit(0))


def parse_yyyymmdd(c: str | Column) -> Column:
    return F.to_date(_c(c), "yyyyMMdd")


def batch_params(c: str | Column) -> list[Column]:
    """Zero-padded year / month / day strings of a date."""
    d = _c(c)
    return [
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
    ]


def file_stem(path: str | Column = "_metadata.file_path") -> Column:
    """Stem of a ``.parquet`` file path (the chunk id of a raw file)."""
    return F.regexp_extract(_c(path), r"([^/]+)\.parquet$", 1)


def date_from_file_name(path: str | Column = "_metadata.file_path") -> Column:
    """``.../YYYY-MM-DD.parquet`` -> date (NULL when the name does not match)."""
    text = F.regexp_extract(_c(path), r"(\d{4}-\d{2}-\d{2})\.parquet$", 1)
    return F.try_to_date(text, "yyyy-MM-dd")
