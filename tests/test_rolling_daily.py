"""Rolling mean (G1/G2) and fused daily aggregates (F1-F6, E3)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.daily import AQ_SPEC, Metric, daily_aggregate
from airshed.operators.rolling import rolling_mean

HOURLY = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("city_id", T.LongType()),
        *[
            T.StructField(c, T.DoubleType())
            for c in ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "carbon_dioxide"]
        ],
    ]
)


def _rolling_loop(rows, width=8):
    """rows (key, time, value): mean of the last ``width`` values of the key, row by row."""
    out, last = {}, {}
    for key, time, value in sorted(rows, key=lambda r: (r[0], r[1])):
        held = last.setdefault(key, [])
        held.append(None if value is None or value != value else value)
        frame = held[-width:]
        full = len(frame) == width and None not in frame
        out[key, time] = math.fsum(frame) / width if full else None
    return out


def _random_series(n_keys=5, per_key=(0, 40), seed=1, gaps=0.15):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n_keys):
        n = int(rng.integers(*per_key))
        t0 = dt.datetime(2024, 1, 1)
        for i in range(n):
            v = float(np.round(rng.uniform(0, 100), 2))
            if rng.random() < gaps:
                v = None
            rows.append((k, t0 + dt.timedelta(hours=int(i * 1.5)), v))
    return rows


@pytest.mark.parametrize("bucket_rows", [None, 7, 16, 1 << 16])
def test_rolling_matches_a_plain_loop(spark, bucket_rows):
    rows = _random_series(n_keys=6, per_key=(0, 60))
    df = spark.createDataFrame(rows, "k long, t timestamp, v double")
    got = {(r.k, r.t): r.r for r in rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=bucket_rows).collect()}
    want = _rolling_loop(rows)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == (None if v is None else pytest.approx(v, abs=1e-9))


def test_rolling_edges_7_8_9_rows(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(7, t0 + dt.timedelta(hours=i), 1.0) for i in range(7)]
    rows += [(8, t0 + dt.timedelta(hours=i), float(i)) for i in range(8)]
    rows += [(9, t0 + dt.timedelta(hours=i), float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "k long, t timestamp, v double")
    out = {(r.k, r.t): r.r for r in rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=7).collect()}
    assert all(out[(7, t0 + dt.timedelta(hours=i))] is None for i in range(7))
    assert out[(8, t0 + dt.timedelta(hours=7))] == pytest.approx(3.5)
    assert out[(9, t0 + dt.timedelta(hours=8))] == pytest.approx(4.5)
    assert sum(v is not None for v in out.values()) == 3


def test_rolling_missing_inside_window_gives_null(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=i), None if i == 3 else 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "k long, t timestamp, v double")
    out = {r.t.hour: r.r for r in rolling_mean(df, ["v"], key="k", order="t", outputs=["r"]).collect()}
    assert [out[h] for h in range(7, 12)] == [None, None, None, None, 1.0]


def test_rolling_row_based_not_time_based(spark):
    """An hour missing from the grid is not padded: the frame is 8 rows."""
    t0 = dt.datetime(2024, 1, 1)
    hours = [0, 1, 2, 4, 5, 6, 7, 8]  # hour 3 missing
    df = spark.createDataFrame([(1, t0 + dt.timedelta(hours=h), float(h)) for h in hours], "k long, t timestamp, v double")
    out = {r.t.hour: r.r for r in rolling_mean(df, ["v"], key="k", order="t", outputs=["r"]).collect()}
    assert out[8] == pytest.approx(sum(hours) / 8)


def _hourly_fixture():
    """Two cities over two days, NaN and NULL values, a null city, CO != ozone."""
    t0 = dt.datetime(2024, 3, 1, 18)
    rows = []
    for city in (1, 2):
        for i in range(14):  # crosses midnight
            t = t0 + dt.timedelta(hours=i)
            oz = 10.0 + i + city
            co = 100.0 + 2 * i
            pm = float("nan") if i == 2 else 5.0 + i
            no2 = None if i == 4 else 1.0 * i
            rows.append((t, city, pm, pm / 2 if i != 5 else None, co, no2, 0.5 * i, oz, 400.0 + i))
    rows.append((t0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0))
    return rows


def _daily_loop(rows):
    """(city, day) -> the seven measures, from plain loops over the hours."""
    known = [r for r in rows if r[1] is not None]
    ozone = _rolling_loop([(r[1], r[0], r[7]) for r in known])
    monoxide = _rolling_loop([(r[1], r[0], r[4]) for r in known])
    days = {}
    for r in known:
        days.setdefault((r[1], r[0].date()), []).append(r)
    real = lambda values: [v for v in values if v is not None and v == v]
    mean = lambda values: sum(v) / len(v) if (v := real(values)) else None
    most = lambda values: max(real(values), default=None)
    return {
        key: {
            "pm2_5_mean": mean(r[3] for r in hours),
            "pm10_mean": mean(r[2] for r in hours),
            "carbon_dioxide_mean": mean(r[8] for r in hours),
            "ozone_8h_max": most(ozone[r[1], r[0]] for r in hours),
            "carbon_monoxide_8h_max": most(monoxide[r[1], r[0]] for r in hours),
            "nitrogen_dioxide_1h_max": most(r[5] for r in hours),
            "sulphur_dioxide_1h_max": most(r[6] for r in hours),
        }
        for key, hours in days.items()
    }


@pytest.mark.parametrize("bucket_rows", [None, 7])
def test_daily_air_quality_matches_a_plain_loop(spark, bucket_rows):
    rows = _hourly_fixture()
    got = daily_aggregate(spark.createDataFrame(rows, HOURLY), AQ_SPEC, bucket_rows=bucket_rows).collect()
    want = _daily_loop(rows)
    assert len(got) == len(want) == 4
    for r in got:
        for c, v in want[r.city_id, r.date].items():
            assert r[c] == (None if v is None else pytest.approx(v)), c


def test_daily_co_reads_its_own_column_and_legacy_mode(spark):
    rows = _hourly_fixture()
    df = spark.createDataFrame(rows, HOURLY)
    fixed = {(r.city_id, r.date): r for r in daily_aggregate(df).collect()}
    assert all(r.carbon_monoxide_8h_max != r.ozone_8h_max for r in fixed.values() if r.ozone_8h_max is not None)
    legacy_spec = tuple(Metric(m.out, "ozone", m.how) if m.out == "carbon_monoxide_8h_max" else m for m in AQ_SPEC)
    legacy = daily_aggregate(df, legacy_spec).collect()
    assert all(r.carbon_monoxide_8h_max == r.ozone_8h_max for r in legacy)


def test_daily_reset_restarts_at_midnight(spark):
    rows = _hourly_fixture()
    df = spark.createDataFrame(rows, HOURLY)
    crossing = {(r.city_id, r.date): r.ozone_8h_max for r in daily_aggregate(df).collect()}
    reset = {(r.city_id, r.date): r.ozone_8h_max for r in daily_aggregate(df, reset_daily=True).collect()}
    # Day 1 has 6 rows (18h-23h): no full frame either way. Day 2 has 8 rows;
    # with reset only its last row has a full frame, crossing frames fill earlier.
    day1, day2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
    assert reset[(1, day1)] is None and crossing[(1, day1)] is None
    assert reset[(1, day2)] == pytest.approx(11.0 + sum(range(6, 14)) / 8)
    assert crossing[(1, day2)] == pytest.approx(11.0 + sum(range(6, 14)) / 8)
    hourly = rows[:14]
    d = spark.createDataFrame(hourly, HOURLY)
    short = d.filter(F.hour("date") != 7)  # day 2 now has 7 rows: only crossing frames fill
    assert daily_aggregate(short, reset_daily=True).filter(F.col("date") == day2).first().ozone_8h_max is None
    assert daily_aggregate(short).filter(F.col("date") == day2).first().ozone_8h_max is not None


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame(_hourly_fixture(), HOURLY)
    assert daily_aggregate(df).filter(F.col("city_id").isNull()).count() == 0


def test_ordinal_is_the_sorted_position(spark):
    from airshed.operators.ordinal import with_ordinal

    rows = [(k % 7, (k * 7919) % 1000, k) for k in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int, id int").repartition(5)
    out = with_ordinal(df, ["a", "b", "id"])
    assert dict(out.dtypes)["_ord"] == "bigint"
    got = out.orderBy("_ord").collect()
    assert [(r.a, r.b, r.id) for r in got] == sorted(rows)
    assert [r._ord for r in got] == list(range(2000))
    empty = with_ordinal(df.limit(0), ["a", "b", "id"])
    assert empty.count() == 0 and dict(empty.dtypes)["_ord"] == "bigint"


def test_hot_key_third_of_rows(spark):
    """One city holds a third of all hourly rows: it is split into buckets
    (with halos) while the others take the plain window; both agree with the
    unsplit window exactly."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, t0 + dt.timedelta(hours=i), float(i % 97) if i % 13 else None) for i in range(3000)]
    for k in range(1, 101):
        rows += [(k, t0 + dt.timedelta(hours=i), float((k * i) % 89)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, t timestamp, v double").repartition(6)
    split = rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=256)
    whole = rolling_mean(df, ["v"], key="k", order="t", outputs=["r"], bucket_rows=None)
    a = {(r.k, r.t): r.r for r in split.collect()}
    b = {(r.k, r.t): r.r for r in whole.collect()}
    assert len(a) == len(rows) and a.keys() == b.keys()
    assert all((a[x] is None) == (b[x] is None) and (a[x] is None or abs(a[x] - b[x]) < 1e-9) for x in b)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "airshed-ordinal" in plan  # cold rows plain, hot rows by position
