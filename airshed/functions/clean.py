"""Missing-value clean-up, decimal quantisation and typed projections.

One representation of "missing" inside the library: SQL NULL. Sentinels and
NaN are turned into NULL in one projection each; every column expression stays
JVM-side (no Python UDF).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.schemas import KEYS, SENTINEL, TableSpec

_FLOATING = (T.FloatType, T.DoubleType)


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def null_sentinel(df: DataFrame, value=SENTINEL, exclude: Iterable[str] = KEYS) -> DataFrame:
    """Replace ``value`` by NULL in every numeric column but the excluded ones."""
    skip = set(exclude)
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit(value)).alias(f.name)
            if f.name not in skip and _numeric(f.dataType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def null_nan(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL on float/double columns (Spark's avg/max would propagate NaN)."""
    wanted = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _FLOATING) and (wanted is None or f.name in wanted):
            out.append(nan_to_null(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def quantize_col(c: Column, dtype: T.DecimalType, on_overflow: str = "error") -> Column:
    """Decimal at ``dtype``'s scale, HALF_UP on the shortest decimal text of the double.

    float32 is widened to double first; NaN and NULL give NULL. Overflow of the
    declared precision raises (ANSI) unless ``on_overflow='null'``.
    """
    d = nan_to_null(c.cast("double"))
    return d.try_cast(dtype) if on_overflow == "null" else d.cast(dtype)


def quantize(
    df: DataFrame,
    spec: TableSpec | dict[str, T.DecimalType],
    scale: int | None = None,
    on_overflow: str = "error",
) -> DataFrame:
    """Quantise the measures present in ``df``; absent measures are skipped.

    ``scale=None`` uses each column's declared (precision, scale); ``scale=2``
    is the uniform mode (DECIMAL(38, 2) for every measure).
    """
    if isinstance(spec, TableSpec):
        types = {m: spec.decimal_of(m, scale) for m in spec.measure_names}
    else:
        types = dict(spec)
    return df.select(
        *[
            quantize_col(F.col(f.name), types[f.name], on_overflow).alias(f.name)
            if f.name in types
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cast_integral(c: str, to: str = "long") -> Column:
    """Float -> integer; a non-integral value is an error, NULL stays NULL."""
    x = F.col(c)
    return (
        F.when(x.isNull(), F.lit(None).cast(to))
        .when(x == F.floor(x), x.cast(to))
        .otherwise(F.raise_error(F.concat(F.lit(f"non-integral value in {c}: "), x.cast("string"))))
        .cast(to)
        .alias(c)
    )


def to_spec(df: DataFrame, spec: TableSpec, scale: int | None = None) -> DataFrame:
    """Staging projection: target schema restricted to keys + measures present.

    Keys are cast to their declared types (``date`` from a timestamp gives the
    UTC calendar day); measures are quantised to their decimals.
    """
    present = set(df.columns)
    cols = []
    for k in spec.keys:
        if k == "date":
            cols.append(F.to_date(F.col(k)).alias(k))
        else:
            cols.append(F.col(k).cast("long").alias(k))
    for m in spec.measure_names:
        if m in present:
            cols.append(quantize_col(F.col(m), spec.decimal_of(m, scale)).alias(m))
    return df.select(*cols)
