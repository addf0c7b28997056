"""Validated writes, batch definitions, chunk files, quarantine, heavy keys, carried state."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators import quality as Q
from airshed.operators.cities import assign_chunks
from airshed.operators.daily import AQ_SPEC, daily_aggregate, last_rows
from airshed.operators.heavy import heavy_keys, key_hash, missed_rows
from airshed.operators.rolling import rolling_mean
from airshed.operators.series import judge_bodies, quarantine
from airshed.plans import pipelines as P
from airshed.schemas import AIR_QUALITY_VARS, DAILY_AIR_QUALITY, raw_series_schema
from airshed.sources.batches import BatchDefinition
from airshed.sources.readers import read_chunk_files, read_stem_chunks
from airshed.sources.versioned import read_table, versions
from airshed.sources.writers import write_chunk_files, write_raw_chunks
from airshed.streaming.incremental import RollingState, start_loader

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
DAILY = "date date, city_id long, a double, b double"
SUITE = [
    Q.columns_match_set(["date", "city_id", "a", "b"]),
    Q.compound_unique(["city_id", "date"]),
    Q.between("a", 0, 10),
    Q.between("b", 0, None, mostly=0.5, severity=Q.WARNING),
    Q.pair_ge("a", "b", severity=Q.WARNING),
    Q.not_null("a"),
    Q.fits("b", "decimal(4,2)"),
]


def daily_rows(seed=1, n=400):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, float("nan"), -1.0, 0.0, 3.25, 10.0, 11.0, 99.994, 99.996, 1e9])
    return [(rng.choice([D1, D2, None]), rng.choice([1, 2, 3, 4, 5, None, *range(100, 300)]), value(), value()) for _ in range(n)]


# --- one observed write


@pytest.mark.parametrize("rows", [daily_rows(), []])
def test_checked_write_counts_what_run_suite_counts(spark, tmpdir_path, rows):
    df = spark.createDataFrame(rows, DAILY).repartition(6)
    report, counts = Q.checked_write(
        df, SUITE, lambda x: x.write.parquet(f"{tmpdir_path}/t"), ["date", "city_id"], counts={"all": F.count(F.lit(1))}
    )
    want = {r["idx"]: (r["evaluated"], r["unexpected"], r["success"]) for r in Q.run_suite(df, SUITE).collect()}
    assert {r["idx"]: (r["evaluated"], r["unexpected"], r["success"]) for r in report} == want
    assert counts == {"all": len(rows)} and spark.read.schema(DAILY).parquet(f"{tmpdir_path}/t").count() == len(rows)


def test_checked_write_checks_what_it_keeps(spark, tmpdir_path):
    rows = daily_rows(3)
    df = spark.createDataFrame(rows, DAILY)
    keep = F.coalesce(F.col("date") == F.lit(D1), F.lit(False))
    report, _ = Q.checked_write(df, SUITE, lambda x: x.write.parquet(f"{tmpdir_path}/t"), ["date", "city_id"], keep=keep)
    want = {r["idx"]: (r["evaluated"], r["unexpected"]) for r in Q.run_suite(df.filter(keep), SUITE).collect()}
    assert {r["idx"]: (r["evaluated"], r["unexpected"]) for r in report} == want
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == sum(r[0] == D1 for r in rows)


def test_checked_write_is_one_scan_and_one_shuffle(spark, tmpdir_path):
    spark.createDataFrame(daily_rows(), DAILY).write.parquet(f"{tmpdir_path}/in")
    seen = []
    Q.checked_write(spark.read.parquet(f"{tmpdir_path}/in"), SUITE, lambda x: (seen.append(x), x.write.parquet(f"{tmpdir_path}/out")), ["date", "city_id"])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert plan.index("CollectMetrics") < plan.index("Exchange ")  # behind the shuffle


def test_uniqueness_outside_the_layout_is_refused(spark, tmpdir_path):
    with pytest.raises(ValueError, match="layout"):
        Q.checked_write(spark.createDataFrame([], DAILY), [Q.compound_unique(["a"])], lambda x: None, ["date", "city_id"])


def test_load_fails_with_counts_when_values_do_not_fit(spark, tmpdir_path):
    rows = [(D1, c, 1e7 if c < 3 else 1.0) for c in range(5)]
    daily = spark.createDataFrame(rows, "date date, city_id long, pm10_mean double")
    load = lambda frame: P.load_daily(
        spark, "air_quality", frame, P.run_window("daily", D1), f"{tmpdir_path}/copy", f"{tmpdir_path}/t", validate=False
    )
    with pytest.raises(Q.DataQualityError, match=r"fit_declared_type\(pm10_mean\): 3 of 5"):
        load(daily)
    assert not os.path.exists(f"{tmpdir_path}/t")
    assert load(daily.filter("city_id >= 3"))["rows"] == 2


def test_facts_are_checked_against_the_city_table(spark, tmpdir_path):
    """A known city outside this run's chunks loads; an unknown one does not."""
    raw_row = (0, 0, *[int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp()) + k for k in (0, 86400)], 3600, *[[float(h) for h in range(24)]] * len(AIR_QUALITY_VARS))
    raw = {"air_quality": spark.createDataFrame([raw_row], raw_series_schema(AIR_QUALITY_VARS))}
    chunks = spark.createDataFrame([(0, 0, 7)], "chunk_id int, pos int, city_id long")
    cities = spark.createDataFrame([(7,), (8,)], "city_id long")
    assert P.run_daily(spark, D1, chunks, raw, f"{tmpdir_path}/a", cities=cities)[0]["rows"] == 1
    with pytest.raises(Q.DataQualityError, match="city 7 is not in the city table"):
        P.run_daily(spark, D1, chunks, raw, f"{tmpdir_path}/b", cities=cities.filter("city_id = 8"))
    res = P.run_backfill(spark, dt.date(2024, 1, 1), dt.date(2025, 1, 1), chunks, raw, f"{tmpdir_path}/c", cities=cities)
    assert [r["feed"] for r in res] == ["air_quality"] and read_table(spark, f"{tmpdir_path}/c/daily_air_quality").count() == 1


# --- batch definitions


@pytest.fixture()
def months(spark, tmpdir_path):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 5), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 11, 1)]
    for i, day in enumerate(days):
        spark.createDataFrame([(i, k) for k in range(3)], "f long, k long").coalesce(1).write.parquet(f"{tmpdir_path}/{day.isoformat()}.parquet")
    for other in ("notes.txt", "2024-01-05.parquet.bak", "2024-1-7.parquet", "x2024-01-08.parquet"):
        with open(f"{tmpdir_path}/{other}", "w") as f:
            f.write("not a batch")
    return BatchDefinition(tmpdir_path), days


@pytest.mark.parametrize("request_, chosen", [
    ({}, [0, 1, 2, 3, 4]), ({"year": 2024}, [1, 2, 3, 4]), ({"year": "2024", "month": "01"}, [1, 2]), ({"month": 1}, [1, 2]), ({"day": "01"}, [3, 4]),
    ({"year": 2024, "month": 1, "day": 31}, [2]), ({"year": "24"}, []), ({"month": "1"}, []),
])
def test_requests_choose_files_before_the_scan(spark, months, request_, chosen):
    definition, days = months
    found = definition.batches(spark, request_)
    assert [b.path.rpartition("/")[2] for b in found] == [f"{days[i].isoformat()}.parquet" for i in chosen]
    if not chosen:
        with pytest.raises(FileNotFoundError):
            definition.read(spark, request_)
        return
    rows = definition.read_each(spark, request_, "f long, k long")
    opened = {p.split("/")[-2] for p in rows.inputFiles()}
    assert opened == {f"{days[i].isoformat()}.parquet" for i in chosen}
    got = sorted(map(tuple, rows.collect()))
    assert got == sorted((i, k, f"{days[i]:%Y}", f"{days[i]:%m}", f"{days[i]:%d}") for i in chosen for k in range(3))


def test_latest_batch_and_unknown_groups(spark, months):
    definition, _ = months
    assert definition.latest(spark)["month"] == "11" and definition.latest(spark, {"month": 1})["day"] == "31"
    with pytest.raises(ValueError, match="no groups"):
        definition.batches(spark, {"hour": 1})
    chunks = BatchDefinition(definition.folder, r"(?P<name>[a-z]+)\.txt")
    assert [b["name"] for b in chunks.batches(spark)] == ["notes"]


def test_chunk_id_from_the_file_stem(spark, tmpdir_path):
    for chunk in (0, 12):
        spark.createDataFrame([(chunk,)], "v long").coalesce(1).write.parquet(f"{tmpdir_path}/{chunk}")
        part = next(n for n in os.listdir(f"{tmpdir_path}/{chunk}") if n.startswith("part-"))
        os.rename(f"{tmpdir_path}/{chunk}/{part}", f"{tmpdir_path}/{chunk}.parquet")
    got = read_stem_chunks(spark, [f"{tmpdir_path}/0.parquet", f"{tmpdir_path}/12.parquet"], "v long")
    assert sorted(map(tuple, got.collect())) == [(0, 0), (12, 12)]


# --- chunk files


def test_chunk_files_hold_exactly_n_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/chunks"
    df = spark.range(1007).withColumnRenamed("id", "city_id").repartition(5)
    write_chunk_files(assign_chunks(df, ["city_id"], size=30), path, 30)
    index = write_chunk_files(assign_chunks(df, ["city_id"], size=50), path, 50)
    rows = {r["chunk_id"]: (r["file"], r["rows"]) for r in index.collect()}
    assert sorted(rows) == list(range(21)) and [rows[c][1] for c in sorted(rows)] == [50] * 20 + [7]
    assert [rows[c][0] for c in sorted(rows)] == sorted(f for f, _ in rows.values())  # names sort by position
    got = {(r["city_id"], r["chunk_id"], r["pos"]) for r in read_chunk_files(spark, path).collect()}
    assert got == {(i, i // 50, i % 50) for i in range(1007)}
    some = read_chunk_files(spark, path, [3, 20, 99])
    assert sorted(r["city_id"] for r in some.collect()) == [*range(150, 200), *range(1000, 1007)] and len(some.inputFiles()) == 2
    assert read_chunk_files(spark, path, []).count() == 0


# --- bodies

GOOD = '{"properties":{"parameter":{"PS":{"20240101":1.5,"20240102":null},"TS":{"20240101":2}}}}'
BODIES = {
    None: "empty", "": "empty", " \n": "empty", "{": "not json", "oops": "not json", "[1]": "no parameter", "null": "no parameter", "{}": "no parameter",
    '{"properties":{"parameter":null}}': "no parameter", '{"properties":{"parameter":{"PS":null}}}': "no parameter", '{"properties":{"parameter":{"PS":3}}}': "no parameter",
    '{"messages":["bad"]}': "no parameter", GOOD.replace("1.5", '"n/a"'): "not numeric", GOOD.replace("1.5", "{}"): "not numeric", GOOD.replace("1.5", '"2"'): "not numeric", GOOD.replace("1.5", "true"): "not numeric",
    GOOD.replace('"20240102"', '"2024-01-02"'): "bad day", GOOD.replace('"20240102"', '"20241399"'): "bad day", GOOD: None, '{"properties":{"parameter":{}}}': None,
}


def test_bodies_are_judged(spark):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "city_id long, body string")
    got = {r["city_id"]: r["reason"] for r in judge_bodies(raw).collect()}
    assert got == dict(enumerate(BODIES.values()))


def test_quarantine_keeps_both_and_counts_once(spark, tmpdir_path):
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "city_id long, body string").repartition(3)
    for _ in range(2):  # a rerun replaces
        sound, rejected, counts = quarantine(raw, f"{tmpdir_path}/q")
    assert counts == {"ok": 2, **Counter(r for r in BODIES.values() if r)}
    assert {r["city_id"] for r in sound.collect()} == {i for i, r in enumerate(BODIES.values()) if r is None}
    assert {(r["city_id"], r["reason"]) for r in rejected.collect()} == {(i, r) for i, r in enumerate(BODIES.values()) if r}
    assert sound.columns == ["city_id", "body"] and P.land_surface_daily(sound).count() == 2
    with pytest.raises(Exception, match="parameter|MALFORMED"):
        P.land_surface_daily(raw).collect()  # the strict way stays strict


# --- heavy keys


@pytest.mark.parametrize("tracked", [48, 96, 10_000])
def test_no_heavy_key_is_missed_at_the_bound(spark, tracked):
    rng = random.Random(tracked)
    rows = [(rng.choice([None, *[int(rng.paretovariate(0.6)) % 5000 for _ in range(2)]]), rng.randrange(2)) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "k long, day int").repartition(16)
    least = max(200, missed_rows(len(rows), tracked))
    truth = Counter(rows)
    found = {r["hash"]: r["estimate"] for r in heavy_keys(df, ["k", "day"], least, tracked).collect()}
    hashes = {(r["k"], r["day"]): r["h"] for r in df.distinct().withColumn("h", key_hash(["k", "day"])).collect()}
    heavy = [key for key, n in truth.items() if n > least]
    assert heavy and (None, 0) in heavy
    assert all(found.get(hashes[key], 0) >= truth[key] for key in heavy)
    slack = missed_rows(len(rows), tracked)
    assert all(n <= truth[key] + slack for key in truth for n in [found.get(hashes[key], 0)])


def test_a_null_key_with_a_third_of_the_rows_is_split(spark):
    rng = random.Random(5)
    rows = [(None if i % 3 == 0 else i % 50, i, rng.random()) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, t long, v double").repartition(7)
    split = rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=256)
    whole = rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=None)
    rounded = lambda d: sorted((r["t"], r["k"], r["r"] and round(r["r"], 9)) for r in d.collect())
    key = lambda r: (r[0], r[1] or -1, r[2] or -1)
    assert sorted(rounded(split), key=key) == sorted(rounded(whole), key=key)
    plan = split._jdf.queryExecution().executedPlan().toString()
    hot = plan.split("airshed-ordinal")[0]
    assert "airshed-ordinal" in plan and "isnotnull(k" not in hot


# --- carried hours


def hours(spark, days, cities=(1, 2, None)):
    rng = random.Random(3)
    rows = []
    for d in range(days):
        for c in cities:
            for h in range(24):
                if rng.random() < 0.9:
                    rows.append((dt.datetime(2024, 3, 1) + dt.timedelta(days=d, hours=h), c, *[rng.random() for _ in AIR_QUALITY_VARS]))
    fields = "date timestamp, city_id long, " + ", ".join(f"{v} double" for v in AIR_QUALITY_VARS)
    return spark.createDataFrame(rows, fields)


def rounded_rows(df):
    cols = sorted(set(df.columns) - {"date", "city_id", "created_at"})
    return sorted((r["city_id"], r["date"], *[None if r[c] is None else round(float(r[c]), 6) for c in cols]) for r in df.collect())


def test_three_runs_with_carried_hours_equal_one(spark, tmpdir_path):
    every = hours(spark, 6)
    state = RollingState(f"{tmpdir_path}/state", lambda rows: rows)
    got = []
    for run in range(3):
        lo, hi = dt.datetime(2024, 3, 1 + 2 * run), dt.datetime(2024, 3, 3 + 2 * run)
        batch = every.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
        for _ in range(2):  # a replayed run sees and leaves the same state
            carried = state.carried(spark, run)
            daily = rounded_rows(daily_aggregate(batch, AQ_SPEC, carried=carried))
            state.carry(spark, run, batch, carried)
        got += daily
    assert sorted(got) == rounded_rows(daily_aggregate(every, AQ_SPEC))
    assert versions(spark, f"{tmpdir_path}/state") == [1, 2, 3]
    alone = [x for run in range(3) for x in rounded_rows(daily_aggregate(every.filter(F.dayofmonth("date").isin(1 + 2 * run, 2 + 2 * run)), AQ_SPEC))]
    assert sorted(alone) != sorted(got)  # the hours carried do matter


def test_last_rows_reach_back_over_short_batches(spark):
    every = hours(spark, 1, cities=(1,)).orderBy("date")
    kept = None
    for h in range(0, 24, 3):
        batch = every.filter((F.hour("date") >= h) & (F.hour("date") < h + 3))
        kept = spark.createDataFrame(last_rows(batch, carried=kept).collect(), every.select("city_id", "date", *sorted({m.src for m in AQ_SPEC})).schema)
    want = sorted(r["date"] for r in every.collect())[-7:]
    assert sorted(r["date"] for r in kept.collect()) == want


def test_stream_of_days_equals_one_batch(spark, tmpdir_path):
    schema = T.StructType([*raw_series_schema(AIR_QUALITY_VARS).fields, T.StructField("run_date", T.DateType())])
    chunks = spark.createDataFrame([(0, p, 100 + p) for p in (0, 1)], "chunk_id int, pos int, city_id long")
    rng = random.Random(8)
    raw_dir, target = f"{tmpdir_path}/raw", f"{tmpdir_path}/daily"
    state = RollingState(f"{tmpdir_path}/state", lambda b: P.air_quality_hourly(b, chunks))
    whole = None
    for d in range(3):
        day = D1 + dt.timedelta(days=d)
        start = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())
        rows = [(0, p, start, start + 86400, 3600, *[[rng.random() for _ in range(24)] for _ in AIR_QUALITY_VARS], day) for p in (0, 1)]
        raw = spark.createDataFrame(rows, schema)
        whole = raw if whole is None else whole.unionByName(raw)
        write_raw_chunks(raw, raw_dir)
        q = start_loader(spark, raw_dir, schema, lambda h, carried: daily_aggregate(h, AQ_SPEC, carried=carried), target, DAILY_AIR_QUALITY, checkpoint_location=f"{tmpdir_path}/ckpt", state=state)
        q.awaitTermination(120)
        assert q.exception() is None
    want = daily_aggregate(P.air_quality_hourly(whole, chunks), AQ_SPEC)
    from airshed.functions.clean import to_spec

    assert rounded_rows(read_table(spark, target)) == rounded_rows(to_spec(want, DAILY_AIR_QUALITY))
