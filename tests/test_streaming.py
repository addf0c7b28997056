"""Incremental loader: new raw files -> micro-batches -> validated keyed upsert."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.quality import AIR_QUALITY_SUITE
from airshed.plans.pipelines import air_quality_daily
from airshed.schemas import AIR_QUALITY_VARS, DAILY_AIR_QUALITY, raw_series_schema
from airshed.sources.versioned import read_table
from airshed.sources.writers import write_raw_chunks
from airshed.streaming.incremental import start_loader

RAW_SCHEMA = T.StructType(list(raw_series_schema(AIR_QUALITY_VARS).fields) + [T.StructField("run_date", T.DateType())])


def _epoch(d):
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp())


def _raw_day(spark, day, value):
    rows = [
        (c, p, _epoch(day), _epoch(day) + 86400, 3600, *[[value + h for h in range(24)] for _ in AIR_QUALITY_VARS], day)
        for c in (0, 1)
        for p in (0, 1)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_loader_processes_new_files_once(spark, tmpdir_path):
    chunks = spark.createDataFrame([(c, p, 100 + 2 * c + p) for c in (0, 1) for p in (0, 1)], "chunk_id int, pos int, city_id long")
    raw_dir, target = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "daily_air_quality")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    clock = iter([dt.datetime(2024, 3, 2, h) for h in range(1, 10)])

    def run():
        q = start_loader(
            spark, raw_dir, RAW_SCHEMA, lambda b: air_quality_daily(b, chunks), target, DAILY_AIR_QUALITY,
            suite=AIR_QUALITY_SUITE, checkpoint_location=ckpt, now=lambda: next(clock),
        )
        q.awaitTermination(120)
        assert q.exception() is None

    d1, d2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    write_raw_chunks(_raw_day(spark, d1, 1.0), raw_dir)
    run()
    first = {(r.date, r.city_id): r for r in read_table(spark, target).collect()}
    assert set(first) == {(d1, c) for c in (100, 101, 102, 103)}
    assert float(first[(d1, 100)].pm10_mean) == 12.5

    write_raw_chunks(_raw_day(spark, d2, 2.0), raw_dir)
    run()
    snap = sorted(map(tuple, read_table(spark, target).collect()))
    assert {r[-1] for r in snap} == {d1, d2} and len(snap) == 8
    created = {(r.date, r.city_id): r.created_at for r in read_table(spark, target).collect()}
    assert created[(d1, 100)] == dt.datetime(2024, 3, 2, 1) and created[(d2, 100)] == dt.datetime(2024, 3, 2, 2)

    run()  # nothing new: no batch, table unchanged
    assert sorted(map(tuple, read_table(spark, target).collect())) == snap
    assert read_table(spark, target).filter(F.col("ozone_8h_max").isNull()).count() == 0
