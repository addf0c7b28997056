"""Combining frames by key or by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_combine(frames: list[DataFrame], keys: list[str], unique_keys: bool = True) -> DataFrame:
    """Full outer equi-join of several frames on ``keys``, keys coalesced.

    When each input has at most one row per key (aggregates do), the chain of
    N-1 sort-merge joins is replaced by one union + one ``groupBy``: a single
    shuffle, map-side combined, and immune to join-key skew. Measure columns
    must be disjoint across inputs; a key that an input has twice is an error.
    ``unique_keys=False`` keeps the join chain (duplicate keys then multiply,
    as a join does).
    """
    if not frames:
        raise ValueError("no frames")
    measures = [[c for c in f.columns if c not in keys] for f in frames]
    flat = [c for ms in measures for c in ms]
    if len(flat) != len(set(flat)):
        raise ValueError("measure columns must be disjoint across inputs")
    if not unique_keys:
        return reduce(lambda a, b: a.join(b, on=keys, how="full_outer"), frames)
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [f.select(*keys, *ms, F.lit(i).alias("_frame")) for i, (f, ms) in enumerate(zip(frames, measures))],
    )
    # One row per key per input: at most one non-NULL value per column.
    counts = [F.sum(F.when(F.col("_frame") == i, 1).otherwise(0)) for i in range(len(frames))]
    combined = stacked.groupBy(*keys).agg(*[F.max(F.col(c)).alias(c) for c in flat], F.greatest(*counts, F.lit(0)).alias("_most"))
    single = F.when(F.col("_most") <= 1, F.lit(True)).otherwise(F.raise_error(F.lit("an input has a key more than once")))
    return combined.filter(single).drop("_most")


def union_chunks(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; duplicates kept; absent columns are NULL."""
    if not frames:
        raise ValueError("no frames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
