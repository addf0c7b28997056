"""airshed: environmental time-series analytics over a city dimension, on Spark.

Raw daily/hourly feeds (array, map and JSON responses) become clean
``(date, city_id)`` fact tables with the DataFrame API only: series explosion,
positional alignment, sentinel/NaN clean-up, decimal quantisation, daily
means, maxima of rolling 8-row means, hourly maxima, city dedup, top-k and
chunking; declarative data-quality suites gate the load, and keyed upserts
write date-partitioned Parquet tables.
"""

from airshed.functions.clean import cast_integral, null_nan, null_sentinel, quantize, to_spec
from airshed.functions.period import RunWindow, in_window, run_window
from airshed.operators.cities import (
    assign_chunks,
    clean_cities,
    dedup_first,
    request_batches,
    scan_position,
    top_cities,
    top_cities_sql,
)
from airshed.operators.combine import outer_combine, union_chunks
from airshed.operators.daily import AQ_SPEC, Metric, daily_aggregate
from airshed.operators.ordinal import with_ordinal
from airshed.operators.quality import (
    AIR_QUALITY_SUITE,
    CLIMATE_SUITE,
    LAND_SURFACE_SUITE,
    checked_write,
    gate,
    orphans,
    run_suite,
)
from airshed.operators.heavy import heavy_keys
from airshed.operators.rolling import rolling_mean
from airshed.operators.series import explode_series, join_discharge, pivot_keyed_series, quarantine, zip_positional
from airshed.operators.upsert import upsert
from airshed.schemas import DAILY_AIR_QUALITY, DAILY_CLIMATE, DAILY_LAND_SURFACE
from airshed.session import build_session, checkpoint_dir
from airshed.sources.batches import BatchDefinition
from airshed.sources.versioned import merge_versioned, read_table, replace_table, vacuum
from airshed.sources.writers import merge_into

__all__ = [
    "AIR_QUALITY_SUITE", "CLIMATE_SUITE", "DAILY_AIR_QUALITY", "DAILY_CLIMATE", "DAILY_LAND_SURFACE",
    "LAND_SURFACE_SUITE", "BatchDefinition", "checked_write", "heavy_keys", "merge_into", "merge_versioned", "quarantine", "read_table",
    "replace_table", "vacuum",
    "AQ_SPEC", "Metric", "RunWindow", "assign_chunks", "build_session", "cast_integral", "checkpoint_dir",
    "clean_cities", "daily_aggregate", "dedup_first", "explode_series", "gate",
    "in_window", "join_discharge", "null_nan", "null_sentinel", "orphans", "outer_combine",
    "pivot_keyed_series", "quantize", "request_batches", "rolling_mean", "run_suite", "run_window",
    "scan_position", "to_spec", "top_cities", "top_cities_sql", "union_chunks", "upsert", "with_ordinal",
    "zip_positional",
]
