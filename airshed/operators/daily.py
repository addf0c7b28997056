"""Hourly rows -> daily indicators per city.

The source computes four aggregates over the same (city, day) key set and
stitches them with three full outer merges. All of them read the same hourly
rows, so here they are one ``groupBy`` with named aggregates (one partial +
final hash aggregate): the merges become a no-op by construction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions.clean import null_nan
from airshed.operators.rolling import DEFAULT_BUCKET_ROWS, rolling_mean


@dataclass(frozen=True)
class Metric:
    """One output column: ``out`` = ``how`` applied to input column ``src``.

    how: ``mean`` | ``max`` | ``min`` | ``sum`` | ``count`` | ``max_rolling`` (max
    over the day of the ``window``-row rolling mean of ``src``).
    """

    out: str
    src: str
    how: str
    window: int = 8


# Daily air-quality indicators. Carbon monoxide reads its own column (the
# source read ozone by mistake; pass src="ozone" to reproduce that result).
AQ_SPEC = (
    Metric("pm2_5_mean", "pm2_5", "mean"),
    Metric("pm10_mean", "pm10", "mean"),
    Metric("carbon_dioxide_mean", "carbon_dioxide", "mean"),
    Metric("ozone_8h_max", "ozone", "max_rolling"),
    Metric("carbon_monoxide_8h_max", "carbon_monoxide", "max_rolling"),
    Metric("nitrogen_dioxide_1h_max", "nitrogen_dioxide", "max"),
    Metric("sulphur_dioxide_1h_max", "sulphur_dioxide", "max"),
)

_SIMPLE = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


def _rolled(m: Metric) -> str:
    return f"_{m.src}_roll{m.window}"


def daily_aggregate(
    hourly: DataFrame,
    spec=AQ_SPEC,
    key: str = "city_id",
    ts: str = "date",
    reset_daily: bool = False,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
    carried: DataFrame | None = None,
) -> DataFrame:
    """(ts, key, measures...) -> (key, date, one column per metric).

    Rows with a NULL key or time are dropped first (group keys never NULL).
    NaN counts as missing. ``reset_daily`` restarts rolling frames at midnight
    (the daily-batch behaviour); by default frames cross days. ``carried``
    are the last rows of earlier batches (``last_rows``): frames reach back to
    them, but they are in no aggregate.
    """
    srcs = sorted({m.src for m in spec})
    named = [F.col(key), F.col(ts), *[F.col(s) for s in srcs]]
    keyed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    df = hourly.select(*named).filter(keyed)
    if carried is not None:
        df = df.withColumn("_carried", F.lit(False)).unionByName(carried.select(*named).filter(keyed).withColumn("_carried", F.lit(True)))
    df = null_nan(df, srcs).withColumn("_day", F.to_date(F.col(ts)))
    # The window is partitioned by the key (plus the day when frames reset at
    # midnight); grouping by the same attributes reuses that partitioning, so
    # rolling + daily aggregate cost one shuffle.
    window_key = [key, "_day"] if reset_daily else [key]
    rolled = [m for m in spec if m.how == "max_rolling"]
    for window in sorted({m.window for m in rolled}):
        these = sorted({m.src for m in rolled if m.window == window})
        df = rolling_mean(
            df,
            these,
            key=window_key,
            order=ts,
            rows=window,
            outputs=[f"_{s}_roll{window}" for s in these],
            bucket_rows=bucket_rows,
        )
    if carried is not None:
        df = df.filter(~F.col("_carried"))
    aggs: list[Column] = []
    for m in spec:
        if m.how == "max_rolling":
            aggs.append(F.max(F.col(_rolled(m))).alias(m.out))
        else:
            aggs.append(_SIMPLE[m.how](F.col(m.src)).alias(m.out))
    return df.groupBy(F.col(key), F.col("_day").alias("date")).agg(*aggs)


def last_rows(hourly: DataFrame, spec=AQ_SPEC, key: str = "city_id", ts: str = "date", carried: DataFrame | None = None) -> DataFrame:
    """The rows that the next batch's frames reach back to: of each key the
    last ``window - 1`` rows of this batch and of what it was carried itself.
    The ranking is cut to them before its shuffle, so a hot key sends few rows."""
    names = [key, ts, *sorted({m.src for m in spec})]
    rows = hourly.select(*names)
    if carried is not None:
        rows = rows.unionByName(carried.select(*names))
    reach = max((m.window for m in spec if m.how == "max_rolling"), default=1) - 1
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts)))
    keyed = rows.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return keyed.withColumn("_rank", rank).filter(F.col("_rank") <= reach).drop("_rank")
