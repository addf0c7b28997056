"""Keyed upsert (MERGE) as one set-based plan.

matched keys      -> the ``update_cols`` take the source value (a NULL
                     overwrites); every other target column keeps its value
source-only keys  -> inserted; ``created_at`` = ``now``
target-only keys  -> kept as they are

One full outer join on the keys. Keys are not NULL and unique on each side
(the writer checks both sides), so no join key can be hot.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Keys must be present and unique: one aggregate, its worst keys."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    worst = counts.agg(
        F.count_if(null).alias("nulls"), F.max_by(F.struct(*keys), F.col("n")).alias("key"), F.max("n").alias("n")
    ).first()
    if worst["nulls"]:
        raise ValueError(f"{what} has NULL keys")
    if worst["n"] and worst["n"] > 1:
        raise ValueError(f"{what} has duplicate keys, e.g. {worst['key'].asDict()}")


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Resolve repeated source keys: the row with the greatest ``order`` wins
    (NULL is the least)."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(F.col(order).isNotNull(), F.col(order))).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    now: dt.datetime | Column | None = None,
    created_col: str | None = "created_at",
) -> DataFrame:
    """Merge ``source`` into ``target``; the result has ``target``'s schema.

    ``update_cols`` defaults to every non-key source column (the wide form);
    pass a subset for the narrow form (e.g. only ``lat``, ``lng``).
    """
    src_cols = [c for c in source.columns if c not in keys]
    update_cols = list(src_cols if update_cols is None else update_cols)
    missing = [c for c in update_cols if c not in source.columns or c not in target.columns]
    if missing:
        raise ValueError(f"update columns absent from source or target: {missing}")
    if now is None:
        now_col = F.current_timestamp()
    elif isinstance(now, Column):
        now_col = now
    else:
        now_col = F.lit(now)

    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys], F.lit(True).alias("_in_t"))
    key_types = {f.name: f.dataType for f in target.schema.fields if f.name in keys}
    s = source.select(
        *[F.col(k).cast(key_types[k]).alias(k) for k in keys],
        *[F.col(c).alias(f"_s_{c}") for c in src_cols],
        F.lit(True).alias("_in_s"),
    )
    j = t.join(s, keys, "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()

    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.col(c))
            continue
        tv = F.col(f"_t_{c}")
        if c in update_cols:
            v = F.when(in_s, F.col(f"_s_{c}").cast(f.dataType)).otherwise(tv)
        elif created_col is not None and c == created_col:
            v = F.when(in_t, tv).otherwise(now_col.cast(f.dataType))
        elif c in src_cols:
            v = F.when(in_t, tv).otherwise(F.col(f"_s_{c}").cast(f.dataType))
        else:
            v = F.when(in_t, tv).otherwise(F.lit(None).cast(f.dataType))
        out.append(v.alias(c))
    return j.select(*out)
