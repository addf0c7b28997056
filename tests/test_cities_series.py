"""City operators (A1, C3, C6, F7, D1, D2, D4, D5) and series feeds (A7-A10, E1, E2)."""

import datetime as dt
import json
import os

import pytest

from airshed.operators.cities import assign_chunks, clean_cities, dedup_first, request_batches, top_cities
from airshed.operators.series import (
    explode_series,
    join_discharge,
    pivot_keyed_series,
    series_length_check,
    zip_positional,
)
from airshed.schemas import LAND_SURFACE_VARS, raw_series_schema
from airshed.sources.readers import read_cities_csv

CSV = """city,city_ascii,lat,lng,country,iso2,iso3,admin_name,capital,population,id
Tokyo,Tokyo,35.6897,139.6922,Japan,JP,JPN,Tokyo,primary,37732000,1392685764
Twin,Twin,10.5,20.25,Nowhere,NW,NWH,,,,1000000001
TwinLater,TwinLater,10.5,20.25,Nowhere,NW,NWH,,,5,1000000002
Delhi,Delhi,28.61,77.23,India,IN,IND,Delhi,admin,32226000.0,1356872604
"""


def test_clean_cities_from_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "worldcities.csv")
    with open(p, "w") as f:
        f.write(CSV)
    out = clean_cities(read_cities_csv(spark, p))
    rows = {r.city_id: r for r in out.collect()}
    assert set(rows) == {1392685764, 1000000001, 1356872604}  # first of the (lat, lng) twins kept
    assert rows[1000000001].population is None
    assert rows[1356872604].population == 32226000
    assert "id" not in out.columns and dict(out.dtypes)["population"] == "bigint"


def test_dedup_first_is_order_stable_under_partitioning(spark):
    rows = [(i % 3, i // 3, i) for i in range(300)]  # keys (k, ~100 groups), pos = i
    df = spark.createDataFrame(rows, "k int, g int, pos long").repartition(7)
    out = {(r.k,): r.g for r in dedup_first(df.select("k", "g", "pos"), ["k"], "pos").collect()}
    assert out == {(0,): 0, (1,): 0, (2,): 0}


def _cities(spark):
    rows = [
        (1, 10.0, 1.0, "A", 500), (2, 11.0, 2.0, "A", None), (3, 12.0, 3.0, "A", 700),
        (4, 13.0, 4.0, "A", 700), (5, 14.0, 5.0, "B", 900),
    ]
    return spark.createDataFrame(rows, "city_id long, lat double, lng double, country string, population long")


def test_top_cities_nulls_last_ties_by_id(spark):
    got = [r.city_id for r in top_cities(_cities(spark), country="A", n=3).collect()]
    assert got == [3, 4, 1]
    got = [r.city_id for r in top_cities(_cities(spark), country="A", n=10).collect()]
    assert got == [3, 4, 1, 2]
    head = [r.city_id for r in top_cities(_cities(spark), n=2, by=None).collect()]
    assert head == [1, 2]


@pytest.mark.parametrize("n", [0, 1, 50, 51, 100])
def test_assign_chunks_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "city_id")
    out = assign_chunks(df, ["city_id"], size=50).orderBy("city_id").collect()
    assert [(r.chunk_id, r.pos) for r in out] == [(i // 50, i % 50) for i in range(n)]


def test_request_batches_keep_pos_order(spark):
    df = spark.createDataFrame(
        [(0, 1, 7, 1.5, 2.5), (0, 0, 9, 3.25, 4.0), (1, 0, 8, 5.0, 6.0)],
        "chunk_id int, pos int, city_id long, lat double, lng double",
    ).repartition(3)
    out = {r.chunk_id: r for r in request_batches(df).collect()}
    assert out[0].city_id_list == "9,7" and out[0].lat_list == "3.25,1.5" and out[0].n == 2
    assert out[1].lng_list == "6"
    small = spark.createDataFrame([(0, 0, 1, 0.0005, -100.0)], "chunk_id int, pos int, city_id long, lat double, lng double")
    assert tuple(request_batches(small).first()[2:]) == ("1", "0.0005", "-100")


# ---------------------------------------------------------------------------

T0 = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp())


def _raw(spark, rows, variables):
    return spark.createDataFrame(rows, raw_series_schema(variables))


def test_explode_series_times_and_values(spark):
    raw = _raw(spark, [(0, 0, T0, T0 + 3 * 3600, 3600, [1.5, float("nan"), 2.675], [0.0, None, 1.0])], ["a", "b"])
    out = explode_series(raw, ["a", "b"]).orderBy("date").collect()
    assert [r.date.hour for r in out] == [0, 1, 2]
    assert out[1].a is None and out[1].b is None
    assert out[2].a == pytest.approx(2.675, abs=1e-6)  # float32 widened
    assert dict(explode_series(raw, ["a", "b"]).dtypes)["a"] == "double"


def test_explode_series_daily_24_steps(spark):
    raw = _raw(spark, [(0, 0, T0, T0 + 86400, 3600, [float(i) for i in range(24)])], ["a"])
    assert explode_series(raw, ["a"]).count() == 24


def test_explode_series_unequal_lengths(spark):
    raw = _raw(spark, [(0, 0, T0, T0 + 2 * 86400, 86400, [1.0, 2.0], [3.0])], ["a", "b"])
    with pytest.raises(Exception, match="differ in length"):
        explode_series(raw, ["a", "b"]).collect()
    padded = explode_series(raw, ["a", "b"], strict=False).orderBy("date").collect()
    assert [r.b for r in padded] == [3.0, None]
    assert series_length_check(raw, ["a", "b"]).count() == 1


def test_zip_positional_stops_at_shorter(spark):
    ids = spark.createDataFrame([(0, p, 100 + p) for p in range(5)], "chunk_id int, pos int, city_id long")
    resp = spark.createDataFrame([(0, p, float(p)) for p in range(3)], "chunk_id int, pos int, v double")
    assert sorted(r.city_id for r in zip_positional(ids, resp).collect()) == [100, 101, 102]


def test_join_discharge_inner_and_left(spark):
    c = spark.createDataFrame([(1, dt.date(2024, 1, d), 1.0) for d in (1, 2, 3)], "city_id long, date date, t double")
    d = spark.createDataFrame([(1, dt.date(2024, 1, d), 9.0) for d in (1, 2)], "city_id long, date date, river_discharge double")
    assert join_discharge(c, d).count() == 2
    left = join_discharge(c, d, how="left").orderBy("date").collect()
    assert len(left) == 3 and left[2].river_discharge is None


def test_pivot_keyed_series_union_of_days(spark):
    body = {"properties": {"parameter": {"PS": {"20240101": 101.2, "20240102": 100.9}, "TS": {"20240102": -999}}}}
    raw = spark.createDataFrame([(7, json.dumps(body))], "city_id long, body string")
    out = {r.date: r for r in pivot_keyed_series(raw, LAND_SURFACE_VARS).collect()}
    assert set(out) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert out[dt.date(2024, 1, 1)].TS is None and out[dt.date(2024, 1, 2)].TS == -999.0
    assert out[dt.date(2024, 1, 1)].city_id == 7 and out[dt.date(2024, 1, 2)].GWETROOT is None


def test_pivot_plan_has_no_exchange(spark):
    body = {"properties": {"parameter": {"PS": {"20240101": 1.0}}}}
    raw = spark.createDataFrame([(7, json.dumps(body))], "city_id long, body string")
    plan = pivot_keyed_series(raw, LAND_SURFACE_VARS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_top_cities_sql_binds_parameters(spark):
    from airshed.operators.cities import top_cities_sql

    got = [r.city_id for r in top_cities_sql(spark, _cities(spark), "A", 3).collect()]
    assert got == [3, 4, 1]
    tricky = [r.city_id for r in top_cities_sql(spark, _cities(spark), "A' OR '1'='1", 3).collect()]
    assert tricky == []


def test_city_csv_is_read_by_header_name(spark, tmpdir_path):
    import csv as csvmod
    import io

    rows = list(csvmod.reader(io.StringIO(CSV)))
    order = [10, 9, 0, 2, 3, 1, 4, 5, 6, 7, 8]  # id and population first, the rest shuffled
    p = os.path.join(tmpdir_path, "reordered.csv")
    with open(p, "w", newline="") as f:
        csvmod.writer(f).writerows([[r[i] for i in order] for r in rows])
    a = sorted(map(tuple, clean_cities(read_cities_csv(spark, p)).collect()))
    p0 = os.path.join(tmpdir_path, "plain.csv")
    with open(p0, "w") as f:
        f.write(CSV)
    assert a == sorted(map(tuple, clean_cities(read_cities_csv(spark, p0)).collect()))
    bad = os.path.join(tmpdir_path, "bad.csv")
    with open(bad, "w") as f:
        f.write("city,lat\nX,1.0\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_cities_csv(spark, bad)


def test_outer_combine_paths(spark):
    from airshed.operators.combine import outer_combine, union_chunks

    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k long, a double")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k long, b string")
    c = spark.createDataFrame([(3, True)], "k long, c boolean")
    fused = sorted(map(tuple, outer_combine([a, b, c], ["k"]).collect()))
    joined = sorted(map(tuple, outer_combine([a, b, c], ["k"], unique_keys=False).select("k", "a", "b", "c").collect()))
    assert fused == joined == [(1, 10.0, None, None), (2, 20.0, "x", None), (3, None, "y", True)]
    dup = spark.createDataFrame([(2, "z")], "k long, b2 string").unionByName(spark.createDataFrame([(2, "w")], "k long, b2 string"))
    assert outer_combine([a, dup], ["k"], unique_keys=False).filter("k = 2").count() == 2
    with pytest.raises(Exception, match="more than once"):
        outer_combine([a, dup], ["k"]).collect()
    with pytest.raises(ValueError, match="disjoint"):
        outer_combine([a, a], ["k"])
    u = union_chunks([a, b])
    assert u.columns == ["k", "a", "b"] and u.count() == 4


GOOD = '{"properties": {"parameter": {"PS": {"20240101": 1.0}, "TS": {"20240101": 2.0, "20240102": 3.0}}}}'


@pytest.mark.parametrize("body", ['{"error": "too many requests"}', "not json", None, '{"properties": {}}'])
def test_pivot_fails_on_bad_responses(spark, body):
    raw = spark.createDataFrame([(1, GOOD), (2, body)], "city_id long, body string")
    with pytest.raises(Exception):
        pivot_keyed_series(raw, ["PS", "TS"]).collect()
    assert pivot_keyed_series(raw.filter("city_id = 1"), ["PS", "TS"]).count() == 2


def test_csv_round_trip_keeps_quotes_commas_and_blanks(spark, tmpdir_path):
    from airshed.sources.readers import read_csv
    from airshed.sources.writers import write_csv

    rows = [(1, 'Foo "Bar" Baz, Qux'), (2, "  blanks  "), (3, "line\nfeed"), (4, "back\\slash"), (5, None), (6, '"')]
    df = spark.createDataFrame(rows, "id long, name string")
    path = os.path.join(tmpdir_path, "csv")
    write_csv(df, path)
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == rows


def test_null_order_never_hides_a_row(spark):
    from airshed.operators.upsert import last_per_key

    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, "c", 1)], "k long, v string, o int")
    assert sorted(map(tuple, last_per_key(df, ["k"], "o").select("k", "v").collect())) == [(1, "a"), (2, "c")]
    assert sorted(map(tuple, dedup_first(df, ["k"], "o").select("k", "v").collect())) == [(1, "a"), (2, "c")]
