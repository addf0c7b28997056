"""Keys that hold many rows, found by a frequent-items sketch.

Counting every key exactly shuffles a row per key and task; a sketch of a fixed
size per task is enough to find the heavy ones. Keys are sketched as 64-bit
hashes, so NULL and compound keys count like any other; two keys of one hash
only make a key look heavier than it is.

Error bound: a sketch that tracks ``tracked`` items has a map of the next power
of two over ``tracked`` / 0.75, and of N rows any count is off by at most
3.5 / map size * N (twice that is missed at most, since items are reported by
their lower bound). So every key with more than ``max(min_rows,
missed_rows(N, tracked))`` rows is found; estimates are never below the truth.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000
#: Sketches are merged in this many tasks, then in one (each some 100 kB).
MERGERS = 256


def missed_rows(n: int, tracked: int = TRACKED) -> int:
    """Rows that a key may have and yet not be found among ``n``."""
    return math.ceil(2 * 3.5 / (1 << math.ceil(math.log2(tracked / 0.75))) * n)


def key_hash(groups: list[str]) -> Column:
    """Hash that stands for a key; NULL is a key like any other."""
    return F.xxhash64(*[F.col(g) for g in groups])


def heavy_keys(df: DataFrame, groups: list[str], min_rows: int, tracked: int = TRACKED) -> DataFrame:
    """(hash, estimate) of the keys with more than ``min_rows`` rows, the ones
    that the sketch can't tell from them included."""
    if not 0 < tracked <= 1_000_000:
        raise ValueError("tracked must be from 1 to 1000000")
    hashed = df.select(key_hash(groups).alias("_h"), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_m"))
    sketches = hashed.groupBy("_m").agg(F.expr(f"approx_top_k_accumulate(_h, {tracked})").alias("_s"))
    whole = sketches.agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))
    items = whole.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {tracked})")).alias("_i"))
    return items.select(F.col("_i.item").alias("hash"), F.col("_i.count").alias("estimate")).filter(F.col("estimate") > min_rows)
