"""End-to-end jobs: city bootstrap and selection, daily runs, yearly backfills.

Each feed is one lazy plan from the raw response table to the daily frame;
the frame is written once to a transformed table (the validation and the load
read that copy instead of recomputing), validated, then merged into the
date-partitioned target.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.clean import null_sentinel, to_spec
from airshed.functions.period import RunWindow, in_window, run_window
from airshed.functions.timecols import expected_steps
from airshed.operators.cities import assign_chunks, clean_cities, request_batches, top_cities
from airshed.operators.daily import AQ_SPEC, daily_aggregate
from airshed.operators.quality import SUITES, DataQualityError, checked_write, cities_store_suite, declared_fit, gate, orphans, run_suite
from airshed.operators.series import (
    explode_series,
    join_discharge,
    pivot_keyed_series,
    zip_positional,
)
from airshed.schemas import (
    AIR_QUALITY_VARS,
    CHUNK_SIZE,
    CITIES_PER_RUN,
    CITIES_SCHEMA,
    CLIMATE_VARS,
    DAILY_AIR_QUALITY,
    DAILY_CLIMATE,
    DAILY_LAND_SURFACE,
    DISCHARGE_VARS,
    LAND_SURFACE_RENAME,
    LAND_SURFACE_VARS,
    TableSpec,
)
from airshed.sources.readers import read_cities_csv, read_csv, read_or_build
from airshed.sources.versioned import merge_versioned, replace_table
from airshed.sources.writers import write_csv

# ---------------------------------------------------------------------------
# Cities
# ---------------------------------------------------------------------------


def cities_frame(clean: DataFrame) -> DataFrame:
    """Cleaned city list -> the dimension's declared types."""
    return clean.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CITIES_SCHEMA.fields])


def bootstrap_cities(
    spark: SparkSession, csv_path: str, clean_csv_path: str, cities_path: str, mode: str = "upsert"
) -> DataFrame:
    """CSV -> dedup/cast/rename -> cleaned CSV -> cities table.

    ``upsert``: narrow upsert (an existing city only gets new coordinates;
    other columns stay). ``replace``: bulk load of the cleaned CSV (header row
    skipped) replacing the whole table, as its next version.
    """
    if mode not in ("upsert", "replace"):
        raise ValueError("mode must be 'upsert' or 'replace'")
    clean = clean_cities(read_cities_csv(spark, csv_path))
    write_csv(clean, clean_csv_path)
    source = cities_frame(read_csv(spark, clean_csv_path, clean.schema))
    # Store constraints (NOT NULL, primary key, unique coordinates, lengths) gate the load.
    gate(run_suite(source, cities_store_suite()))
    if mode == "replace":
        return replace_table(spark, cities_path, source, ["city_id"])
    return merge_versioned(
        spark, cities_path, source, ["city_id"], update_cols=["lat", "lng"],
        partition_col=None, created_col=None, target_schema=CITIES_SCHEMA,
    )


def select_city_chunks(
    spark: SparkSession,
    cities: DataFrame,
    chunk_path: str,
    country: str | None = None,
    n: int = CITIES_PER_RUN,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """Top-n cities (by population within a country, or first n by id), cut
    into chunks of ``size``; reused from ``chunk_path`` when already there."""

    def build() -> DataFrame:
        by = "population" if country else None
        picked = top_cities(cities, country=country, n=n, by=by, cols=("city_id", "lat", "lng", "population"))
        rank = [F.col("population").desc_nulls_last(), F.col("city_id")] if by else [F.col("city_id")]
        chunked = assign_chunks(picked, rank, size=size)
        return chunked.select(
            "city_id", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"),
            "chunk_id", "pos",
        )

    return read_or_build(spark, chunk_path, build)


def city_requests(chunks: DataFrame) -> DataFrame:
    return request_batches(chunks)


# ---------------------------------------------------------------------------
# Feeds: raw response tables -> daily frames
# ---------------------------------------------------------------------------


def _with_city(raw: DataFrame, chunks: DataFrame) -> DataFrame:
    """City id onto the raw responses (one row per city and run, unique
    (chunk, pos) keys), before the series are exploded into time steps."""
    return zip_positional(raw, chunks.select("chunk_id", "pos", "city_id")).drop("chunk_id", "pos")


def climate_daily(
    raw_climate: DataFrame, raw_discharge: DataFrame, chunks: DataFrame, how: str = "inner", strict: bool = True
) -> DataFrame:
    """Climate + discharge series -> one row per (date, city_id).

    ``strict``: both feeds of a city must have the same time axis, else the job
    fails. The raw rows (one per city) are joined and checked, and the 16
    vectors expand together: no exploded row is shuffled. Otherwise each feed
    expands on its own axis and the days are joined.
    """
    if strict:
        axis = ("start_s", "end_s", "interval_s")
        on = ["chunk_id", "pos"]
        other = raw_discharge.select(*on, F.struct(*axis).alias("_axis"), *DISCHARGE_VARS)
        both = _with_city(raw_climate.join(other, on, how), chunks)
        same = F.col("_axis").isNull() | (F.struct(*axis) == F.col("_axis"))
        both = both.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("climate and discharge series differ in their time axis"))))
        if how == "left":  # a city without discharge has NULL for all its days
            n = expected_steps(*axis)
            both = both.withColumns({v: F.coalesce(v, F.array_repeat(F.lit(None).cast("float"), n)) for v in DISCHARGE_VARS})
        rows = explode_series(both, [*CLIMATE_VARS, *DISCHARGE_VARS], keys=("city_id",))
        return rows.select(F.to_date("date").alias("date"), "city_id", *CLIMATE_VARS, *DISCHARGE_VARS)
    climate = explode_series(_with_city(raw_climate, chunks), CLIMATE_VARS, keys=("city_id",))
    discharge = explode_series(_with_city(raw_discharge, chunks), DISCHARGE_VARS, keys=("city_id",))
    joined = join_discharge(climate, discharge, keys=("city_id", "date"), how=how)
    return joined.select(F.to_date("date").alias("date"), "city_id", *CLIMATE_VARS, *DISCHARGE_VARS)


def air_quality_hourly(raw_air: DataFrame, chunks: DataFrame) -> DataFrame:
    return explode_series(_with_city(raw_air, chunks), AIR_QUALITY_VARS, keys=("city_id",))


def air_quality_daily(raw_air: DataFrame, chunks: DataFrame, reset_daily: bool = False, spec=AQ_SPEC) -> DataFrame:
    """A city has at most 8,784 hourly rows in a year's response, so the rolling
    frames need no split of hot cities."""
    return daily_aggregate(air_quality_hourly(raw_air, chunks), spec, reset_daily=reset_daily, bucket_rows=None)


def land_surface_daily(raw_land: DataFrame) -> DataFrame:
    """Keyed JSON -> wide rows, descriptive names, -999 -> NULL (keys kept)."""
    wide = pivot_keyed_series(raw_land, LAND_SURFACE_VARS)
    return null_sentinel(wide.withColumnsRenamed(LAND_SURFACE_RENAME), exclude=("date", "city_id"))


# ---------------------------------------------------------------------------
# Runs
# ---------------------------------------------------------------------------

FEEDS = {
    "climate": DAILY_CLIMATE,
    "air_quality": DAILY_AIR_QUALITY,
    "land_surface": DAILY_LAND_SURFACE,
}


def load_daily(
    spark: SparkSession,
    feed: str,
    daily: DataFrame,
    window: RunWindow,
    transformed_path: str,
    target_path: str,
    now: dt.datetime | None = None,
    validate: bool = True,
    scale: int | None = None,
    cities: DataFrame | None = None,
) -> dict:
    """Restrict to the run window, write the transformed copy, validate it,
    and upsert it into the target table. Returns the validation report rows and
    the numbers of rows loaded and left out as outside the window.

    The transformed copy of a window is a folder of its own and is replaced
    whole by a rerun. Its write counts everything that is checked: the daily
    frame is computed and scanned once. Rows without a date or city, cities
    unknown to ``cities`` (the city table), values that their declared type
    can't hold and a run without rows are errors. The target is a versioned
    table (``read_table``): a load becomes visible whole, or not at all.
    """
    spec: TableSpec = FEEDS[feed]
    inside, keyed = in_window("date", window), F.col("date").isNotNull() & F.col("city_id").isNotNull()
    copy = f"{transformed_path.rstrip('/')}/window={window.lo}_{window.hi}"
    suite = [*(SUITES[feed] if validate else []), *declared_fit(spec, daily.columns, scale)]

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(copy)

    counted = {"rows": F.count_if(keyed & inside), "outside": F.count_if(keyed & ~inside), "unkeyed": F.count_if(~keyed)}
    report, counts = checked_write(daily, suite, write, ["date", "city_id"], keep=keyed & inside, counts=counted)
    if counts["unkeyed"]:
        raise DataQualityError(f"{feed}: {counts['unkeyed']} rows without date or city_id")
    if not counts["rows"]:
        raise DataQualityError(f"{feed}: no rows in {window.lo}..{window.hi}")
    staged = spark.read.schema(daily.schema).parquet(copy)
    if cities is not None and (unknown := orphans(staged, cities).select("city_id").first()):
        raise DataQualityError(f"{feed}: city {unknown['city_id']} is not in the city table")
    failed = gate(report)
    source = to_spec(staged, spec, scale=scale)
    merge_versioned(spark, target_path, source, list(spec.keys), now=now, target_schema=spec.schema(scale))
    return {"feed": feed, "window": (window.lo, window.hi), "warnings": failed, "rows": counts["rows"], "outside": counts["outside"]}


def _daily_frames(raw: dict[str, DataFrame], chunks: DataFrame) -> dict[str, DataFrame]:
    """The daily frame of every feed present in ``raw``."""
    out = {}
    if "climate" in raw:
        out["climate"] = climate_daily(raw["climate"], raw["discharge"], chunks)
    if "air_quality" in raw:
        out["air_quality"] = air_quality_daily(raw["air_quality"], chunks)
    if "land_surface" in raw:
        out["land_surface"] = land_surface_daily(raw["land_surface"])
    return out


def run_daily(
    spark: SparkSession,
    day: dt.date,
    chunks: DataFrame,
    raw: dict[str, DataFrame],
    out_dir: str,
    now: dt.datetime | None = None,
    cities: DataFrame | None = None,
) -> list[dict]:
    """The daily run: every feed present in ``raw`` (keys ``climate``,
    ``discharge``, ``air_quality``, ``land_surface``); land surface lags a day.
    Every city has to be in ``cities``, the city table (default: the chunks)."""
    out_dir = out_dir.rstrip("/")
    known = chunks if cities is None else cities
    results = []
    for feed, daily in _daily_frames(raw, chunks).items():
        window = run_window("daily", day, lag_days=1 if feed == "land_surface" else 0)
        copy, target = f"{out_dir}/transformed/daily_{feed}", f"{out_dir}/daily_{feed}"
        results.append(load_daily(spark, feed, daily, window, copy, target, now, cities=known))
    return results


def run_backfill(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    chunks: DataFrame,
    raw: dict[str, DataFrame],
    out_dir: str,
    now: dt.datetime | None = None,
    half_open: bool = False,
    cities: DataFrame | None = None,
) -> list[dict]:
    """Yearly backfill of the feeds in ``raw`` (no validation stage)."""
    out_dir = out_dir.rstrip("/")
    known = chunks if cities is None else cities
    window = run_window("yearly", start, end, half_open=half_open)
    results = []
    for feed, daily in _daily_frames(raw, chunks).items():
        copy, target = f"{out_dir}/transformed/backfill_{feed}", f"{out_dir}/daily_{feed}"
        results.append(load_daily(spark, feed, daily, window, copy, target, now, validate=False, cities=known))
    return results
