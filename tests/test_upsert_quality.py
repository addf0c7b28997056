"""Upserts and the merge sink (B1-B9, E4) and data-quality suites (J1-J10, E5)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from airshed.operators import quality as Q
from airshed.operators.upsert import assert_unique_keys, last_per_key, upsert
from airshed.schemas import DAILY_AIR_QUALITY
from airshed.sources.readers import read_day, read_dated_file, read_or_build
from airshed.sources.writers import merge_into, write_partitioned

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 6, 1)
D1, D2, D3 = dt.date(2024, 5, 1), dt.date(2024, 5, 2), dt.date(2024, 5, 3)


def _target(spark):
    return spark.createDataFrame(
        [(D1, 1, 1.0, "a", T0), (D1, 2, 2.0, "b", T0), (D2, 1, 3.0, "c", T0)],
        "date date, city_id long, m double, note string, created_at timestamp",
    )


def _source(spark):
    return spark.createDataFrame(
        [(D1, 1, None), (D2, 1, 30.0), (D3, 5, 50.0)], "date date, city_id long, m double"
    )


def test_upsert_semantics(spark):
    out = {(r.date, r.city_id): r for r in upsert(_target(spark), _source(spark), ["date", "city_id"], now=NOW).collect()}
    assert out[(D1, 1)].m is None and out[(D1, 1)].note == "a" and out[(D1, 1)].created_at == T0  # NULL overwrites
    assert out[(D1, 2)].m == 2.0  # target-only kept
    assert out[(D2, 1)].m == 30.0 and out[(D2, 1)].created_at == T0
    assert out[(D3, 5)].m == 50.0 and out[(D3, 5)].note is None and out[(D3, 5)].created_at == NOW


def test_upsert_idempotent(spark):
    keys = ["date", "city_id"]
    once = upsert(_target(spark), _source(spark), keys, now=NOW)
    twice = upsert(once, _source(spark), keys, now=dt.datetime(2030, 1, 1))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_upsert_narrow_keeps_other_columns(spark):
    target = spark.createDataFrame([(1, "Old", 1.0, 2.0)], "city_id long, city string, lat double, lng double")
    source = spark.createDataFrame([(1, "New", 5.0, 6.0), (2, "Fresh", 7.0, 8.0)], "city_id long, city string, lat double, lng double")
    out = {r.city_id: r for r in upsert(target, source, ["city_id"], update_cols=["lat", "lng"], created_col=None).collect()}
    assert out[1].city == "Old" and (out[1].lat, out[1].lng) == (5.0, 6.0)
    assert out[2].city == "Fresh"


def test_duplicate_source_keys(spark):
    dup = spark.createDataFrame([(D1, 1, 1.0, 1), (D1, 1, 2.0, 2)], "date date, city_id long, m double, v int")
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique_keys(dup, ["date", "city_id"])
    assert last_per_key(dup, ["date", "city_id"], "v").first().m == 2.0


def test_merge_into_partitioned_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "daily_air_quality")
    schema = DAILY_AIR_QUALITY.schema()
    first = spark.createDataFrame([(D1, 1), (D2, 1), (D2, 2)], "date date, city_id long").select(
        "date", "city_id", F.lit(1.5).cast("decimal(8,2)").alias("pm2_5_mean")
    )
    merge_into(spark, path, first, ["date", "city_id"], now=T0, target_schema=schema)
    src = spark.createDataFrame([(D2, 1), (D3, 9)], "date date, city_id long").select(
        "date", "city_id", F.lit(2.5).cast("decimal(8,2)").alias("pm2_5_mean")
    )
    merge_into(spark, path, src, ["date", "city_id"], now=NOW, target_schema=schema)
    snap = sorted((r.date, r.city_id, float(r.pm2_5_mean), r.created_at) for r in spark.read.parquet(path).collect())
    assert snap == [(D1, 1, 1.5, T0), (D2, 1, 2.5, T0), (D2, 2, 1.5, T0), (D3, 9, 2.5, NOW)]
    # rerun with the same source: nothing moves (created_at included)
    merge_into(spark, path, src, ["date", "city_id"], now=dt.datetime(2031, 1, 1), target_schema=schema)
    again = sorted((r.date, r.city_id, float(r.pm2_5_mean), r.created_at) for r in spark.read.parquet(path).collect())
    assert again == snap
    assert [d for d in sorted(os.listdir(path)) if d.startswith("date=")] == [
        "date=2024-05-01", "date=2024-05-02", "date=2024-05-03",
    ]
    day = read_day(spark, path, D2)
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 2


def test_merge_into_rejects_duplicates(spark, tmpdir_path):
    dup = spark.createDataFrame([(D1, 1, 1.0), (D1, 1, 2.0)], "date date, city_id long, m double")
    with pytest.raises(ValueError):
        merge_into(spark, os.path.join(tmpdir_path, "t"), dup, ["date", "city_id"])


def test_read_or_build_and_dated_file(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "chunks")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert read_or_build(spark, p, build).count() == 3
    assert read_or_build(spark, p, build).count() == 3 and len(calls) == 1
    folder = os.path.join(tmpdir_path, "daily")
    for d in (D1, D2):
        spark.range(int(d.day)).write.parquet(os.path.join(folder, f"{d.isoformat()}.parquet"))
    assert read_dated_file(spark, folder, D2).count() == 2


def test_write_partitioned_sorted_by_city(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "facts")
    df = spark.createDataFrame([(D1, c) for c in (5, 3, 9, 1)], "date date, city_id long")
    write_partitioned(df, p)
    assert [r.city_id for r in spark.read.parquet(os.path.join(p, "date=2024-05-01")).collect()] == [1, 3, 5, 9]


# ---------------------------------------------------------------------------


def _aq_frame(spark, rows):
    cols = Q.AIR_QUALITY_COLUMNS
    return spark.createDataFrame(rows, ", ".join(f"{c} {'long' if c == 'city_id' else 'date' if c == 'date' else 'double'}" for c in cols))


def test_suite_bounds_nulls_and_unique(spark):
    ok = (1, D1, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    below = (2, D1, -0.01, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    nulls = (3, D1, None, None, None, None, None, None, None)
    dup = (1, D1, 5.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    rep = {r.column: r for r in Q.run_suite(_aq_frame(spark, [ok, below, nulls, dup]), Q.AIR_QUALITY_SUITE).collect()}
    assert rep["city_id,date"].unexpected == 2 and rep["city_id,date"].evaluated == 4
    assert rep["pm2_5_mean"].evaluated == 3 and rep["pm2_5_mean"].unexpected == 1 and not rep["pm2_5_mean"].success
    assert rep["pm10_mean"].success and rep["*"].success
    with pytest.raises(Q.DataQualityError):
        Q.gate(Q.run_suite(_aq_frame(spark, [ok, below]), Q.AIR_QUALITY_SUITE))
    assert Q.gate(Q.run_suite(_aq_frame(spark, [ok]), Q.AIR_QUALITY_SUITE)) == []


def test_pair_checks_are_warnings(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, None), (3.0, None), (5.0, 5.0)], "temperature_2m_max double, temperature_2m_mean double"
    )
    suite = [Q.pair_ge("temperature_2m_max", "temperature_2m_mean", severity=Q.WARNING)]
    r = Q.run_suite(df, suite).first()
    assert (r.evaluated, r.unexpected, r.success) == (3, 2, False)
    failed = Q.gate(Q.run_suite(df, suite))
    assert len(failed) == 1 and failed[0]["severity"] == Q.WARNING


def test_column_set_and_mostly(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 5.0)], "b long, a double")
    rep = Q.run_suite(df, [Q.columns_match_set(["a", "b", "b"]), Q.between("a", 0, 1, mostly=0.5)]).collect()
    assert rep[0].success if rep[0].column == "*" else rep[1].success
    assert all(r.success for r in rep)
    extra = Q.run_suite(df, [Q.columns_match_set(["a"])]).first()
    assert extra.unexpected == 1 and not extra.success


def test_orphans_and_store_checks(spark):
    cities = spark.createDataFrame([(1, "X", "JP")], "city_id long, city string, iso2 string")
    fact = spark.createDataFrame([(D1, 1), (D1, 2), (D1, None)], "date date, city_id long")
    assert [r.city_id for r in Q.orphans(fact, cities).collect()] == [2]
    bad = spark.createDataFrame([(1, None, "JPN")], "city_id long, city string, iso2 string")
    rep = {(r.expectation, r.column): r for r in Q.run_suite(bad, [Q.not_null("city"), Q.max_length("iso2", 2)]).collect()}
    assert all(not r.success for r in rep.values())


def test_suite_counts_in_one_pass(spark):
    df = _aq_frame(spark, [(1, D1, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)])
    plan = Q.run_suite(df, Q.AIR_QUALITY_SUITE)._jdf.queryExecution().executedPlan().toString()
    # one aggregate for 7 row checks (partial+final) + one for uniqueness (2 levels)
    assert plan.count("HashAggregate") <= 6


def test_write_chunks_and_raw_chunks(spark, tmpdir_path):
    from airshed.sources.writers import write_chunks, write_raw_chunks

    chunked = spark.createDataFrame([(c, p, c * 10 + p) for c in range(3) for p in range(4)], "chunk_id int, pos int, city_id long")
    write_chunks(chunked, os.path.join(tmpdir_path, "chunks"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "chunks", "chunk_id=1"))
    assert [r.pos for r in back.collect()] == [0, 1, 2, 3]
    raw = spark.createDataFrame([(D1, 0, 1.0), (D1, 1, 2.0), (D2, 0, 3.0)], "run_date date, chunk_id int, v double")
    p = os.path.join(tmpdir_path, "raw")
    write_raw_chunks(raw, p)
    write_raw_chunks(raw.filter("chunk_id = 0").withColumn("v", F.col("v") * 10), p)  # rerun of chunk 0
    got = sorted((r.run_date, r.chunk_id, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(D1, 0, 10.0), (D1, 1, 2.0), (D2, 0, 30.0)]


def test_between_bounds_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (-0.001,), (100.001,), (None,)], "cloud_cover_mean double")
    r = Q.run_suite(df, [Q.between("cloud_cover_mean", 0, 100)]).first()
    assert (r.evaluated, r.unexpected) == (4, 2)


def test_column_set_missing_and_reordered(spark):
    df = spark.createDataFrame([(1, 2)], "date long, city_id long")
    r = Q.run_suite(df, [Q.columns_match_set(["city_id", "date"])]).first()
    assert r.success and r.unexpected == 0
    r2 = Q.run_suite(df, [Q.columns_match_set(["city_id", "date", "pm10_mean"])]).first()
    assert not r2.success and r2.unexpected == 1


def test_merge_into_leaves_no_staging_copy(spark, tmpdir_path):
    from airshed.session import checkpoint_dir

    before = {d for d in os.listdir(checkpoint_dir(spark)) if d.startswith("airshed-merge-")}
    src = spark.createDataFrame([(D1, 1, 1.0)], "date date, city_id long, m double")
    merge_into(spark, os.path.join(tmpdir_path, "t"), src, ["date", "city_id"], now=T0)
    merge_into(spark, os.path.join(tmpdir_path, "t"), src, ["date", "city_id"], now=T0)
    after = {d for d in os.listdir(checkpoint_dir(spark)) if d.startswith("airshed-merge-")}
    assert after == before


def test_orphans_with_a_hot_key(spark):
    cities = spark.createDataFrame([(k,) for k in range(0, 50)], "city_id long")
    fact = spark.createDataFrame(
        [(D1, 0)] * 300 + [(D1, 55)] * 300 + [(D1, k) for k in range(40, 60)] + [(D1, None)], "date date, city_id long"
    )
    assert sorted(r.city_id for r in Q.orphans(fact, cities).collect()) == sorted(list(range(50, 60)) + [55] * 300)


def _merge_rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("date", "city_id", "m").collect()))


def test_merge_into_casts_keys_first(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    merge_into(spark, path, spark.createDataFrame([(D1, 1, 1.0), (D1, 2, 2.0)], "date date, city_id long, m double"), ["date", "city_id"], now=T0)
    at_six = spark.createDataFrame([(dt.datetime(2024, 5, 1, 6), 3, 3.0)], "date timestamp, city_id int, m double")
    merge_into(spark, path, at_six, ["date", "city_id"], now=NOW)
    assert _merge_rows(spark, path) == [(D1, 1, 1.0), (D1, 2, 2.0), (D1, 3, 3.0)]
    twice = spark.createDataFrame([(dt.datetime(2024, 5, 1, h), 3, 3.0) for h in (6, 7)], "date timestamp, city_id int, m double")
    with pytest.raises(ValueError, match="duplicate"):
        merge_into(spark, path, twice, ["date", "city_id"], now=NOW)


@pytest.mark.parametrize("row", [(None, 1, 1.0), (D1, None, 1.0)])
def test_merge_into_rejects_null_keys(spark, tmpdir_path, row):
    path = os.path.join(tmpdir_path, "t")
    schema = "date date, city_id long, m double"
    merge_into(spark, path, spark.createDataFrame([(D1, 1, 1.0)], schema), ["date", "city_id"], now=T0)
    with pytest.raises(ValueError, match="NULL keys"):
        merge_into(spark, path, spark.createDataFrame([row], schema), ["date", "city_id"], now=NOW)
    assert _merge_rows(spark, path) == [(D1, 1, 1.0)]


def test_merge_into_checks_the_target_and_never_takes_a_bad_table_for_none(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    df = spark.createDataFrame([(D1, 1, 1.0), (D1, 1, 2.0)], "date date, city_id long, m double")
    df.write.partitionBy("date").parquet(path)
    with pytest.raises(ValueError, match="target has duplicate"):
        merge_into(spark, path, df.limit(1), ["date", "city_id"], created_col=None)
    broken = os.path.join(tmpdir_path, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "x.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        merge_into(spark, broken, df.limit(1), ["city_id"], partition_col=None)
    assert os.listdir(broken) == ["x.parquet"]


def test_unpartitioned_merge_survives_a_broken_swap(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "cities")
    schema = "city_id long, m double"
    merge_into(spark, path, spark.createDataFrame([(1, 1.0)], schema), ["city_id"], partition_col=None, created_col=None)
    os.rename(path, path + "__old")  # as if the job died between the two renames
    merge_into(spark, path, spark.createDataFrame([(2, 2.0)], schema), ["city_id"], partition_col=None, created_col=None)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 1.0), (2, 2.0)]
    assert sorted(os.listdir(tmpdir_path)) == ["cities"]


def test_chunk_files_replace_all_chunks(spark, tmpdir_path):
    from airshed.sources.writers import write_chunks

    path = os.path.join(tmpdir_path, "chunks")
    write_chunks(spark.createDataFrame([(c, 0, c) for c in range(3)], "chunk_id int, pos int, city_id long"), path)
    write_chunks(spark.createDataFrame([(0, 0, 9)], "chunk_id int, pos int, city_id long"), path)
    assert [r.city_id for r in spark.read.parquet(path).collect()] == [9]


def test_nan_is_within_no_bounds(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    r = Q.run_suite(df, [Q.between("v", 0, None)]).first()
    assert (r.evaluated, r.unexpected, r.success) == (2, 1, False)


def test_merge_into_crash_before_commit_then_rerun(spark, tmpdir_path, monkeypatch):
    from airshed.sources import writers

    path = os.path.join(tmpdir_path, "t")
    first = spark.createDataFrame([(D1, 1, 1.0), (D2, 2, 2.0)], "date date, city_id long, m double")
    merge_into(spark, path, first, ["date", "city_id"], now=T0)
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    src = spark.createDataFrame([(D2, 2, 20.0), (D3, 3, 30.0)], "date date, city_id long, m double")

    real = writers.write_partitioned

    def crash(*a, **k):
        raise RuntimeError("executor lost while writing the table")

    monkeypatch.setattr(writers, "write_partitioned", crash)
    with pytest.raises(RuntimeError) as err:
        merge_into(spark, path, src, ["date", "city_id"], now=NOW)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before  # target untouched
    kept = err.value.__notes__[0].split(" at ")[1]
    # the merged rows of the touched days (D2, D3) survive for recovery; D1 is never rewritten
    assert sorted((r.date, r.city_id, r.m) for r in spark.read.parquet(kept).collect()) == [(D2, 2, 20.0), (D3, 3, 30.0)]
    monkeypatch.setattr(writers, "write_partitioned", real)
    merge_into(spark, path, src, ["date", "city_id"], now=NOW)
    got = sorted((r.date, r.city_id, r.m, r.created_at) for r in spark.read.parquet(path).collect())
    assert got == [(D1, 1, 1.0, T0), (D2, 2, 20.0, T0), (D3, 3, 30.0, NOW)]
