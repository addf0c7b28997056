"""spark-submit entry points: city bootstrap + selection, daily run, backfill.

Raw responses live under ``RAW/<feed>/run_date=YYYY-MM-DD/chunk_id=N/`` (as
``write_raw_chunks`` writes them); feeds are ``climate``, ``discharge``,
``air_quality`` and ``land_surface``. A run reads only its run date (partition
pruning) and writes the tables under ``OUT``.

  spark-submit airshed/plans/cli.py cities --csv worldcities.csv --clean-csv OUT/clean \\
      --cities OUT/cities --chunks OUT/city_chunks [--country Japan] [--n 100]
  spark-submit airshed/plans/cli.py daily --day 2024-03-02 --raw RAW --chunks OUT/city_chunks --cities OUT/cities --out OUT
  spark-submit airshed/plans/cli.py backfill --start 2024-01-01 --end 2025-01-01 --raw RAW \\
      --chunks OUT/city_chunks --cities OUT/cities --out OUT

The targets are versioned tables: read them with ``read_table``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from airshed.plans import pipelines as P  # noqa: E402
from airshed.schemas import (  # noqa: E402
    AIR_QUALITY_VARS,
    CHUNK_SIZE,
    CITIES_PER_RUN,
    CLIMATE_VARS,
    DISCHARGE_VARS,
    RAW_LAND_SURFACE_SCHEMA,
    raw_series_schema,
)
from airshed.session import ensure_utc, path_exists  # noqa: E402
from airshed.sources.versioned import read_table  # noqa: E402

RUN_DATE = T.StructField("run_date", T.DateType(), True)
RAW_SCHEMAS = {
    "climate": raw_series_schema(CLIMATE_VARS),
    "discharge": raw_series_schema(DISCHARGE_VARS),
    "air_quality": raw_series_schema(AIR_QUALITY_VARS),
    "land_surface": T.StructType(
        list(RAW_LAND_SURFACE_SCHEMA.fields) + [T.StructField("chunk_id", T.IntegerType(), True)]
    ),
}


def read_raw(spark: SparkSession, raw_dir: str, feed: str, run_date: dt.date) -> DataFrame:
    schema = T.StructType(list(RAW_SCHEMAS[feed].fields) + [RUN_DATE])
    path = f"{raw_dir.rstrip('/')}/{feed}"
    return spark.read.schema(schema).parquet(path).filter(F.col("run_date") == F.lit(run_date)).drop("run_date")


def _feeds(spark: SparkSession, raw_dir: str, wanted: list[str] | None) -> list[str]:
    """The feeds that have a folder in the store of ``raw_dir``."""
    present = [f for f in RAW_SCHEMAS if path_exists(spark, f"{raw_dir.rstrip('/')}/{f}")]
    chosen = [f for f in present if not wanted or f in wanted]
    if not chosen or set(wanted or ()) - set(present):
        raise ValueError(f"feeds wanted: {wanted or 'any'}; found below {raw_dir}: {present or 'none'}")
    return chosen


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    ap = argparse.ArgumentParser(prog="airshed")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("cities")
    c.add_argument("--csv", required=True)
    c.add_argument("--clean-csv", required=True)
    c.add_argument("--cities", required=True)
    c.add_argument("--chunks", required=True)
    c.add_argument("--mode", choices=["upsert", "replace"], default="upsert")
    c.add_argument("--country")
    c.add_argument("--n", type=int, default=CITIES_PER_RUN)
    c.add_argument("--size", type=int, default=CHUNK_SIZE)
    for name in ("daily", "backfill"):
        r = sub.add_parser(name)
        r.add_argument("--raw", required=True)
        r.add_argument("--chunks", required=True)
        r.add_argument("--out", required=True)
        r.add_argument("--cities", help="the city table: every row's city has to be in it (default: the chunks)")
        r.add_argument("--feeds", nargs="*")
        if name == "daily":
            r.add_argument("--day", required=True, type=dt.date.fromisoformat)
        else:
            r.add_argument("--start", required=True, type=dt.date.fromisoformat)
            r.add_argument("--end", required=True, type=dt.date.fromisoformat)
            r.add_argument("--half-open", action="store_true")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"airshed-{args.cmd}").getOrCreate()
    ensure_utc(spark)
    if args.cmd == "cities":
        cities = P.bootstrap_cities(spark, args.csv, args.clean_csv, args.cities, mode=args.mode)
        chunks = P.select_city_chunks(spark, cities, args.chunks, country=args.country, n=args.n, size=args.size)
        return [{"cities": cities.count(), "chunked": chunks.count()}]

    chunks = spark.read.parquet(args.chunks)
    run_date = args.day if args.cmd == "daily" else args.start
    raw = {f: read_raw(spark, args.raw, f, run_date) for f in _feeds(spark, args.raw, args.feeds)}
    if "climate" in raw and "discharge" not in raw:
        raise ValueError("the climate feed needs the discharge feed")
    cities = read_table(spark, args.cities) if args.cities else None
    if args.cmd == "daily":
        return P.run_daily(spark, args.day, chunks, raw, args.out, cities=cities)
    return P.run_backfill(spark, args.start, args.end, chunks, raw, args.out, half_open=args.half_open, cities=cities)


if __name__ == "__main__":
    print(json.dumps(main(), default=str))
