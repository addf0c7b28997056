"""Row-based rolling mean per key (pandas ``rolling(window, min_periods)``).

The frame is the ``rows`` preceding rows of the same key including the current
one; the mean skips missing values and is NULL unless at least ``min_rows``
values are present. Row-based, not time-based: gaps in the hour grid are not
padded, and the frame crosses midnight unless ``reset_by`` restarts it.

Skew: ``Window.partitionBy(key)`` sends all rows of one key to one task. So
a frequent-items sketch (``operators/heavy.py``) finds the keys with more than
``bucket_rows`` rows, NULL among them, and their hashes are written to a
scratch table; there are about rows / ``bucket_rows`` of them at most. A key
that the sketch takes for heavy without need only goes the longer way.
All other keys take the plain window
(one shuffle, and its hash partitioning on the key also serves a later
``groupBy`` on key + day). Hot keys get their global position in (key, order)
order, are cut into buckets of ``bucket_rows`` positions, and the last
``rows - 1`` rows of each bucket are copied into the next one as a halo. Their
window is partitioned by (key, bucket): no task holds more than
``bucket_rows + rows - 1`` rows of a hot key, and the result is exact. The
planner chooses the joins with the hot keys by their size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.operators.heavy import heavy_keys, key_hash
from airshed.operators.ordinal import with_ordinal
from airshed.session import delete_at_exit, scratch_path

DEFAULT_BUCKET_ROWS = 1 << 20


def _frame_cols(cols, outputs, w, min_rows):
    return [
        F.when(F.count(F.col(c)).over(w) >= min_rows, F.avg(F.col(c)).over(w)).alias(o) for c, o in zip(cols, outputs)
    ]


def _plain(df, groups, order, cols, outputs, halo, min_rows):
    w = Window.partitionBy(*groups).orderBy(order).rowsBetween(-halo, 0)
    return df.select("*", *_frame_cols(cols, outputs, w, min_rows))


def _bucketed(df, groups, order, cols, outputs, halo, min_rows, bucket_rows):
    pos = with_ordinal(df, [F.col(g) for g in groups] + [F.col(order)], out="_ord")
    own = F.expr(f"_ord div {int(bucket_rows)}")
    in_tail = (F.col("_ord") - own * bucket_rows) >= (bucket_rows - halo)
    copies = F.when(in_tail & F.lit(halo > 0), F.array(own, own + 1)).otherwise(F.array(own))
    spread = pos.withColumn("_own", own).withColumn("_b", F.explode(copies))
    w = Window.partitionBy(*groups, "_b").orderBy("_ord").rowsBetween(-halo, 0)
    return (
        spread.select("*", *_frame_cols(cols, outputs, w, min_rows))
        .filter(F.col("_b") == F.col("_own"))
        .drop("_ord", "_own", "_b")
    )


def _hot_keys(df: DataFrame, groups: list[str], bucket_rows: int) -> DataFrame:
    """Hashes of the keys with more than ``bucket_rows`` rows, sketched once."""
    path = scratch_path(df.sparkSession, "hot-keys")
    hot = heavy_keys(df, groups, bucket_rows).select(F.col("hash").alias("_hot"))
    hot.write.parquet(path)
    delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(hot.schema).parquet(path)


def rolling_mean(
    df: DataFrame,
    cols: list[str],
    key: str | list[str] = "city_id",
    order: str = "date",
    rows: int = 8,
    min_rows: int | None = None,
    reset_by: Column | None = None,
    outputs: list[str] | None = None,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """Add one rolling-mean column per input column (named by ``outputs``).

    ``order`` must be unique within a key (the source sorts by city and hour).
    ``bucket_rows=None`` skips the hot-key split (for series whose length per
    key is bounded by construction).
    """
    min_rows = rows if min_rows is None else min_rows
    outputs = outputs or [f"{c}_rolling_{rows}" for c in cols]
    groups = [key] if isinstance(key, str) else list(key)
    if reset_by is not None:
        df = df.withColumn("_reset", reset_by)
        groups.append("_reset")
    halo = rows - 1
    args = (groups, order, cols, outputs, halo, min_rows)

    if bucket_rows is None:
        out = _plain(df, *args)
    else:
        if bucket_rows < max(halo, 1):
            raise ValueError("bucket_rows must be at least rows - 1")
        hot = _hot_keys(df, groups, bucket_rows)
        if hot.isEmpty():
            out = _plain(df, *args)
        else:
            is_hot = key_hash(groups) == F.col("_hot")  # by hash: NULL keys compare too
            cold = _plain(df.join(hot, is_hot, "left_anti"), *args)
            warm = _bucketed(df.join(hot, is_hot, "left_semi"), *args, bucket_rows)
            out = cold.unionByName(warm)
    if reset_by is not None:
        out = out.drop("_reset")
    return out
