"""Sentinel / NaN clean-up, quantisation, integral casts (C6-C10) and run windows (I6)."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.clean import cast_integral, null_nan, null_sentinel, quantize, to_spec
from airshed.functions.period import in_window, run_window
from airshed.functions.timecols import batch_params, date_from_file_name, file_stem, parse_yyyymmdd, step_times
from airshed.schemas import DAILY_AIR_QUALITY, DAILY_LAND_SURFACE


def test_sentinel_to_null_keeps_keys(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), -999, -999.0, 5.0, "-999"), (dt.date(2024, 1, 2), 7, 1.0, -999.0, "x")],
        "date date, city_id long, a double, b double, s string",
    )
    out = null_sentinel(df).orderBy("date").collect()
    assert out[0].city_id == -999 and out[0].a is None and out[0].b == 5.0 and out[0].s == "-999"
    assert out[1].b is None and out[1].a == 1.0


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), None)], "a double, b float")
    rows = null_nan(df).collect()
    assert rows[1].a is None and rows[1].b is None and rows[0].a == 1.0
    assert null_nan(df).schema == df.schema


def _half_up(value, places=2):
    """Half-up on the digits of the shortest decimal text, by integer arithmetic."""
    if value is None or value != value:
        return None
    sign, digits, exponent = Decimal(repr(float(value))).as_tuple()
    number, drop = int("".join(map(str, digits))), -exponent - places
    if drop > 0:
        number, rest = divmod(number, 10**drop)
        number += 2 * rest >= 10**drop
    else:
        number *= 10**-drop
    return Decimal(-number if sign else number).scaleb(-places)


def test_quantize_matches_shortest_text_half_up(spark):
    vals = [2.675, 1.005, 0.125, -2.675, 0.145, 1.115, 12345.675, -0.005, 0.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "pm2_5_mean double")
    got = [r[0] for r in quantize(df, DAILY_AIR_QUALITY).collect()]
    assert got == [_half_up(v) for v in vals]


def test_quantize_float32_widened_first(spark):
    vals = [np.float32(2.675), np.float32(1.005), np.float32(0.125), np.float32(-3.14159)]
    df = spark.createDataFrame([(float(v),) for v in vals], "pm10_mean float")
    got = [r[0] for r in quantize(df, DAILY_AIR_QUALITY).collect()]
    assert got == [_half_up(v) for v in vals]


def test_quantize_column_scale_and_uniform(spark):
    df = spark.createDataFrame([(0.123456, 0.98765)], "root_zone_soil_wetness double, all_sky_surface_albedo double")
    r = quantize(df, DAILY_LAND_SURFACE).first()
    assert r[0] == Decimal("0.1235") and r[1] == Decimal("0.9877")
    r2 = quantize(df, DAILY_LAND_SURFACE, scale=2).first()
    assert r2[0] == Decimal("0.12") and r2[1] == Decimal("0.99")


def test_quantize_overflow_is_error(spark):
    df = spark.createDataFrame([(12345678.0,)], "pm2_5_mean double")  # > decimal(8,2)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        quantize(df, DAILY_AIR_QUALITY).collect()
    assert quantize(df, DAILY_AIR_QUALITY, on_overflow="null").first()[0] is None


def test_to_spec_skips_absent_measures(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 13), 3, 1.005, 9.0)], "date timestamp, city_id int, pm2_5_mean double, extra double"
    )
    out = to_spec(df, DAILY_AIR_QUALITY)
    assert out.columns == ["date", "city_id", "pm2_5_mean"]
    r = out.first()
    assert r.date == dt.date(2024, 1, 1) and r.pm2_5_mean == Decimal("1.01")
    assert dict(out.dtypes)["city_id"] == "bigint"


def test_cast_integral(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3000000.0,)], "population double")
    assert [r[0] for r in df.select(cast_integral("population")).collect()] == [1, None, 3000000]
    bad = spark.createDataFrame([(1.5,)], "population double")
    with pytest.raises(Exception, match="non-integral"):
        bad.select(cast_integral("population")).collect()


# ---------------------------------------------------------------------------


def test_run_window_daily_yearly_lag():
    d = dt.datetime(2024, 3, 1, 0, 0)
    assert run_window("daily", d) == run_window("daily", dt.date(2024, 3, 1))
    w = run_window("daily", dt.date(2024, 1, 1), lag_days=1)
    assert (w.lo, w.hi) == (dt.date(2023, 12, 31), dt.date(2023, 12, 31))  # lag into the old year
    y = run_window("yearly", dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    assert y.days() == 367  # leap year + inclusive end
    assert run_window("yearly", dt.date(2024, 1, 1), dt.date(2025, 1, 1), half_open=True).days() == 366
    with pytest.raises(ValueError, match="no run window"):
        run_window("monthly", d)


def test_in_window_is_pushed_to_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    q = df.filter(in_window("o_orderdate", run_window("daily", dt.date(1997, 5, 28))))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderdate" in plan
    assert q.count() == 4


def test_time_helpers(spark):
    df = spark.createDataFrame(
        [(0, 7200, 3600, "20240229", "/a/b/cities3.parquet", "/x/2024-02-29.parquet")],
        "s long, e long, i int, d string, p string, q string",
    )
    r = df.select(
        step_times("s", "e", "i").alias("t"), parse_yyyymmdd("d").alias("d"), file_stem("p").alias("stem"),
        date_from_file_name("q").alias("fd"), date_from_file_name("p").alias("nd"),
        *batch_params(F.to_date(F.lit("2024-02-09"))),
    ).first()
    assert [t.hour for t in r.t] == [0, 1]
    assert r.d == dt.date(2024, 2, 29) and r.stem == "cities3"
    assert r.fd == dt.date(2024, 2, 29) and r.nd is None
    assert (r.year, r.month, r.day) == ("2024", "02", "09")


def test_types_of_decimal_spec():
    s = DAILY_LAND_SURFACE.schema()
    assert s["all_sky_surface_albedo"].dataType == T.DecimalType(6, 4)
    assert DAILY_LAND_SURFACE.schema(scale=2)["all_sky_surface_albedo"].dataType == T.DecimalType(38, 2)


def test_quantize_property_random_doubles(spark):
    import random

    rng = random.Random(11)
    vals = [round(rng.uniform(-1000, 1000), 3) for _ in range(1500)]
    vals += [float(np.float32(rng.uniform(-500, 500))) for _ in range(1500)]
    vals += [round(rng.uniform(0, 1000), 2) * round(rng.uniform(0, 1), 2) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in vals], "pm2_5_mean double")
    got = [r[0] for r in quantize(df, DAILY_AIR_QUALITY, scale=2).collect()]
    assert got == [_half_up(v) for v in vals]
