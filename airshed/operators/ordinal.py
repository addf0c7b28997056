"""Global row position without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here
the frame is range-partitioned on the order columns (the sampled bounds split
a hot key over many partitions), sorted inside each partition, and every row
gets ``offset(partition) + index-in-partition``. The offsets table has one row
per partition, so broadcasting it has a proven size bound.

The id ``partition << 33 | index`` is computed inside the job that writes the
sorted frame as a Parquet table in the shared checkpoint folder, so it is
stored, not recomputed: the per-partition counts (read from the one ``_mid``
column) and the rows see the very same layout, and lineage is cut. A retried
or recomputed task reproduces its ids, because the range bounds are fixed for
the shuffle and the order is total. Inputs of every size take this one path;
the scratch table goes when the application ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.session import delete_at_exit, scratch_path, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | index


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_ordinal(
    df: DataFrame,
    order: list[str | Column],
    out: str = "_ord",
    num_partitions: int | None = None,
) -> DataFrame:
    """Attach ``out`` = 0-based position (long) of each row in ``order``.

    ``order`` must be a total order (break ties with a unique column) for the
    positions to be deterministic across re-runs and lost executors.
    """
    order_cols = _as_cols(order)
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    path = scratch_path(spark, "ordinal")
    (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    delete_at_exit(spark, path)
    sorted_df = (
        spark.read.parquet(path)
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
        .withColumn("_loc", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS))
    )
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        sorted_df.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_off") + F.col("_loc"))
        .drop("_mid", "_pid", "_loc", "_off")
    )
