"""Raw feed responses -> (date, city_id) rows.

A raw response row carries a header (start, end, interval in epoch seconds)
and one value vector per variable; a keyed response is a JSON body
``{"properties": {"parameter": {VAR: {yyyymmdd: value}}}}``. Both expand
in place (generators inside the row's partition): no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.clean import nan_to_null
from airshed.functions.timecols import expected_steps, parse_yyyymmdd
from airshed.schemas import LAND_SURFACE_BODY_SCHEMA


def series_length_check(raw: DataFrame, variables: list[str], keys=("chunk_id", "pos")) -> DataFrame:
    """Rows whose vectors disagree in length with each other or with the header."""
    n = expected_steps("start_s", "end_s", "interval_s")
    sizes = [F.coalesce(F.size(F.col(v)), F.lit(0)) for v in variables]
    bad = F.lit(False)
    for s in sizes:
        bad = bad | (s != n)
    return raw.select(
        *keys, n.alias("expected"), *[s.alias(f"{v}_len") for s, v in zip(sizes, variables)]
    ).filter(bad)


def explode_series(
    raw: DataFrame,
    variables: list[str],
    keys: tuple[str, ...] = ("chunk_id", "pos"),
    ts_col: str = "date",
    strict: bool = True,
) -> DataFrame:
    """One row per time step: keys, ``ts_col`` = start + i * interval (UTC),
    one double column per variable (float32 widened, NaN -> NULL).

    ``strict`` fails the job when a row's vectors disagree in length with each
    other or with the header's step count (a frame cannot hold ragged
    columns); otherwise shorter vectors are padded with NULL.
    """
    n = expected_steps("start_s", "end_s", "interval_s")
    zipped = F.arrays_zip(*[F.col(v) for v in variables])
    body = raw.select(*keys, "start_s", "interval_s", n.alias("_n"), *variables)
    if strict:
        ok = F.lit(True)
        for v in variables:
            ok = ok & (F.coalesce(F.size(F.col(v)), F.lit(0)) == F.col("_n"))
        # A filter (not a projected flag) so that column pruning cannot drop it.
        body = body.filter(
            F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("series vectors and time axis differ in length")))
        )
    exploded = body.select(*keys, "start_s", "interval_s", F.posexplode(zipped).alias("_i", "_v"))
    return exploded.select(
        *keys,
        F.timestamp_seconds(F.col("start_s") + F.col("_i") * F.col("interval_s")).alias(ts_col),
        *[nan_to_null(F.col("_v")[v].cast("double")).alias(v) for v in variables],
    )


def zip_positional(left: DataFrame, right: DataFrame, on=("chunk_id", "pos")) -> DataFrame:
    """Pair rows by position inside their chunk; stops at the shorter side."""
    return left.join(right, list(on), "inner")


def join_discharge(climate: DataFrame, discharge: DataFrame, keys=("city_id", "date"), how: str = "inner") -> DataFrame:
    """Climate rows with the river discharge of the same city and day.

    ``inner`` keeps the days both feeds cover; ``left`` keeps every climate
    row with NULL discharge where the flood feed has none.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    return climate.join(discharge, list(keys), how)


def pivot_keyed_series(
    raw: DataFrame,
    variables: list[str],
    body: str = "body",
    keys: tuple[str, ...] = ("city_id",),
    parsed: str | None = None,
) -> DataFrame:
    """Keyed JSON body -> one row per day with one column per variable.

    The days are the union of the day keys over all variables; a variable
    without a value for a day gives NULL. No shuffle: every row folds its maps
    into one map from day to values, a pass per variable, and expands once.
    A body that is NULL, is not such JSON or has no parameters (an error
    response) fails the job. ``parsed`` names an already-parsed
    map<string, map<string, double>> column instead of a JSON string.
    """
    if parsed is None:
        p = F.from_json(F.col(body), LAND_SURFACE_BODY_SCHEMA, {"mode": "FAILFAST"})["properties"]["parameter"]
    else:
        p = F.col(parsed)
    sound = F.when(F.col("_p").isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit("response without properties.parameter")))
    staged = raw.select(*keys, p.alias("_p")).filter(sound)
    days = F.array_distinct(F.flatten(F.transform(F.map_values(F.col("_p")), lambda m: F.map_keys(m))))
    staged = staged.select(*keys, "_p", days.alias("_days"))
    none = F.array().cast("array<double>")
    folded = F.map_from_arrays(F.col("_days"), F.transform("_days", lambda d: none))
    empty = F.create_map().cast("map<string,double>")
    for v in variables:
        own = F.coalesce(F.try_element_at(F.col("_p"), F.lit(v)), empty)
        folded = F.map_zip_with(folded, own, lambda d, held, x: F.concat(held, F.array(nan_to_null(x.cast("double")))))
    exploded = staged.select(*keys, F.explode(folded).alias("_d", "_v"))
    return exploded.select(
        parse_yyyymmdd(F.col("_d")).alias("date"), *[F.col("_v")[i].alias(v) for i, v in enumerate(variables)], *keys
    )


# Why a keyed body is rejected, in the order that they are looked for.
EMPTY, NOT_JSON, NO_PARAMETER, NOT_NUMERIC, BAD_DAY = "empty", "not json", "no parameter", "not numeric", "bad day"


def judge_bodies(raw: DataFrame, body: str = "body", reason: str = "reason") -> DataFrame:
    """``raw`` with the ``reason`` that its body can't be loaded for (NULL: it
    can). Bodies are parsed as VARIANT, so one parse tells apart text that is no
    JSON, an answer without ``properties.parameter``, a value that is no number
    and a key that is no day (``yyyyMMdd``). JSON null is a missing value."""
    told = F.try_parse_json(F.col(body))
    path = "$.properties.parameter"
    days = F.try_variant_get(F.col("_v"), path, "map<string,map<string,variant>>")
    maps = F.map_values(F.col("_days"))
    keys = F.flatten(F.transform(maps, F.map_keys))
    kinds = F.transform(F.flatten(F.transform(maps, F.map_values)), lambda x: F.schema_of_variant(x))
    number = r"^(VOID|BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
    found = raw.withColumn("_v", told).withColumn("_days", days)
    why = (
        F.when(F.col(body).isNull() | F.col(body).rlike(r"^\s*$"), EMPTY)
        .when(F.col("_v").isNull(), NOT_JSON)
        .when(F.col("_days").isNull() | F.exists(maps, lambda m: m.isNull()), NO_PARAMETER)
        .when(F.exists(kinds, lambda k: ~k.rlike(number)), NOT_NUMERIC)
        .when(F.exists(keys, lambda k: ~k.rlike(r"^\d{8}$") | F.try_to_date(k, "yyyyMMdd").isNull()), BAD_DAY)
    )
    return found.withColumn(reason, why).drop("_v", "_days")


def quarantine(raw: DataFrame, path: str, body: str = "body") -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """One pass over the raw bodies: the sound ones and the rejected ones, each
    with its ``reason``, go to a folder of their own below ``path``. Returns
    (sound, rejected, rows by reason: "ok" and those that occurred)."""
    spark = raw.sparkSession
    reasons = (EMPTY, NOT_JSON, NO_PARAMETER, NOT_NUMERIC, BAD_DAY)
    judged = judge_bodies(raw, body)
    seen = Observation()
    counts = [F.count_if(F.col("reason").isNull()).alias("ok"), *[F.count_if(F.col("reason") == r).alias(r) for r in reasons]]
    out = judged.observe(seen, *counts).withColumn("rejected", F.col("reason").isNotNull())
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(path)
    schema = judged.schema
    kept = spark.read.schema(T.StructType([*schema.fields, T.StructField("rejected", T.BooleanType())])).parquet(path)
    sound = kept.filter(~F.col("rejected")).drop("rejected", "reason")
    found = {k: n for k, n in seen.get.items() if n or k == "ok"}
    return sound, kept.filter("rejected").drop("rejected"), found
