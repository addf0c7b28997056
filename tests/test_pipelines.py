"""End-to-end: city bootstrap and chunking, daily run of three feeds, yearly backfill."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from airshed.operators.quality import DataQualityError
from airshed.plans import pipelines as P
from airshed.schemas import AIR_QUALITY_VARS, CLIMATE_VARS, DISCHARGE_VARS, LAND_SURFACE_VARS, raw_series_schema
from airshed.sources.versioned import read_table

CSV = """city,city_ascii,lat,lng,country,iso2,iso3,admin_name,capital,population,id
A,A,1.0,1.0,X,XX,XXX,,,300,11
B,B,2.0,2.0,X,XX,XXX,,,100,12
B2,B2,2.0,2.0,X,XX,XXX,,,900,13
C,C,3.0,3.0,X,XX,XXX,,,200,14
D,D,4.0,4.0,Y,YY,YYY,,,,15
"""

DAY = dt.date(2024, 3, 2)
NOW = dt.datetime(2024, 3, 3, 1)


def _epoch(d: dt.date, hours=0) -> int:
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp()) + hours * 3600


def _raw_tables(spark, chunks, day=DAY, days=1):
    ids = [(r.chunk_id, r.pos, r.city_id) for r in chunks.collect()]
    start, end = _epoch(day), _epoch(day) + days * 86400
    climate = [
        (c, p, start, end, 86400, *[[0.5 + 0.01 * (cid % 5) for i in range(days)] for _ in CLIMATE_VARS])
        for c, p, cid in ids
    ]
    discharge = [(c, p, start, end, 86400, [1.5] * days) for c, p, cid in ids]
    hourly = [
        (c, p, start - 7 * 3600, end, 3600, *[[float(h % 24) for h in range(days * 24 + 7)] for _ in AIR_QUALITY_VARS])
        for c, p, cid in ids
    ]
    body = lambda: json.dumps(
        {"properties": {"parameter": {v: {(day - dt.timedelta(days=1)).strftime("%Y%m%d"): (-999 if v == "TS" else 900.0 if v in ("PS", "SLP") else 0.5)} for v in LAND_SURFACE_VARS}}}
    )
    land = [(cid, body()) for _, _, cid in ids]
    return {
        "climate": spark.createDataFrame(climate, raw_series_schema(CLIMATE_VARS)),
        "discharge": spark.createDataFrame(discharge, raw_series_schema(DISCHARGE_VARS)),
        "air_quality": spark.createDataFrame(hourly, raw_series_schema(AIR_QUALITY_VARS)),
        "land_surface": spark.createDataFrame(land, "city_id long, body string"),
    }


@pytest.fixture()
def world(spark, tmpdir_path):
    csv = os.path.join(tmpdir_path, "worldcities.csv")
    with open(csv, "w") as f:
        f.write(CSV)
    cities = P.bootstrap_cities(spark, csv, os.path.join(tmpdir_path, "clean_csv"), os.path.join(tmpdir_path, "cities"))
    return tmpdir_path, cities


def test_bootstrap_and_chunks(spark, world):
    root, cities = world
    assert sorted(r.city_id for r in cities.collect()) == [11, 12, 14, 15]  # 13 duplicates 12's coordinates
    assert dict(cities.dtypes)["lat"] == "decimal(9,6)"
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), country="X", n=2, size=1)
    assert [(r.city_id, r.chunk_id, r.pos) for r in chunks.orderBy("chunk_id").collect()] == [(11, 0, 0), (14, 1, 0)]
    req = P.city_requests(chunks).orderBy("chunk_id").collect()
    assert [r.city_id_list for r in req] == ["11", "14"]
    again = P.select_city_chunks(spark, cities.limit(0), os.path.join(root, "chunks"), country="X", n=2, size=1)
    assert again.count() == 2  # reused snapshot


def test_narrow_city_upsert_keeps_names(spark, world, tmpdir_path):
    root, _ = world
    csv2 = os.path.join(tmpdir_path, "worldcities2.csv")
    with open(csv2, "w") as f:
        f.write(CSV.replace("A,A,1.0,1.0", "Renamed,Renamed,1.5,1.25"))
    out = P.bootstrap_cities(spark, csv2, os.path.join(tmpdir_path, "clean2"), os.path.join(root, "cities"))
    a = out.filter(F.col("city_id") == 11).first()
    assert a.city == "A" and float(a.lat) == 1.5 and float(a.lng) == 1.25


def test_daily_run_all_feeds(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=2)
    raw = _raw_tables(spark, chunks)
    out = os.path.join(root, "warehouse")
    res = P.run_daily(spark, DAY, chunks, raw, out, now=NOW)
    assert [r["feed"] for r in res] == ["climate", "air_quality", "land_surface"]
    climate = read_table(spark, os.path.join(out, "daily_climate"))
    assert climate.count() == 4 and climate.filter(F.col("date") == DAY).count() == 4
    assert dict(climate.dtypes)["soil_moisture_0_to_10cm_mean"] == "decimal(8,5)"
    aq = read_table(spark, os.path.join(out, "daily_air_quality"))
    assert aq.count() == 4  # only the run day; the 7 lead-in hours feed the first frames
    r = aq.filter(F.col("city_id") == 11).first()
    assert float(r.ozone_8h_max) == pytest.approx(19.5)  # hours 16..23
    assert float(r.pm10_mean) == pytest.approx(11.5)
    land = read_table(spark, os.path.join(out, "daily_land_surface"))
    lr = land.first()
    assert lr.date == DAY - dt.timedelta(days=1) and lr.land_surface_temp is None and float(lr.surface_pressure) == 900.0
    before = sorted(map(tuple, climate.collect()))
    assert all(r.created_at == NOW for r in climate.collect())
    # rerun: idempotent (created_at does not move)
    P.run_daily(spark, DAY, chunks, raw, out, now=dt.datetime(2030, 1, 1))
    assert sorted(map(tuple, read_table(spark, os.path.join(out, "daily_climate")).collect())) == before


def test_daily_run_blocks_on_critical_failure(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=2)
    raw = _raw_tables(spark, chunks)
    bad = raw["land_surface"].withColumn("body", F.regexp_replace("body", "900.0", "5000.0"))
    with pytest.raises(DataQualityError):
        P.run_daily(spark, DAY, chunks, {"land_surface": bad}, os.path.join(root, "wh"), now=NOW)
    assert not os.path.exists(os.path.join(root, "wh", "daily_land_surface"))


def test_yearly_backfill(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=50)
    start = dt.date(2024, 12, 30)
    raw = _raw_tables(spark, chunks, day=start, days=3)
    out = os.path.join(root, "warehouse")
    P.run_backfill(spark, start, dt.date(2025, 1, 1), chunks, {"climate": raw["climate"], "discharge": raw["discharge"]}, out, now=NOW)
    climate = read_table(spark, os.path.join(out, "daily_climate"))
    assert sorted({r.date for r in climate.collect()}) == [dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
    assert climate.count() == 12


def test_climate_and_discharge_axes_must_agree(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=2)
    raw = _raw_tables(spark, chunks, days=2)
    short = raw["discharge"].withColumn("river_discharge", F.slice("river_discharge", 1, 1)).withColumn(
        "end_s", F.col("start_s") + 86400
    )
    shifted = raw["discharge"].withColumns({c: F.col(c) + 86400 for c in ("start_s", "end_s")})
    for other in (short, shifted):
        with pytest.raises(Exception, match="differ in their time axis"):
            P.climate_daily(raw["climate"], other, chunks).collect()
    assert P.climate_daily(raw["climate"], short, chunks, how="left", strict=False).count() == 8
    assert P.climate_daily(raw["climate"], shifted, chunks, strict=False).count() == 4
    some = raw["discharge"].filter("chunk_id = 0")
    assert P.climate_daily(raw["climate"], some, chunks).count() == 4
    left = P.climate_daily(raw["climate"], some, chunks, how="left")
    assert left.count() == 8 and left.filter("river_discharge IS NULL").count() == 4


def test_climate_rows_are_not_shuffled_after_the_explode(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=2)
    raw = _raw_tables(spark, chunks, days=2)
    plan = P.climate_daily(raw["climate"], raw["discharge"], chunks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "Exchange" not in plan.split("Generate")[0]


def test_fact_constraints_and_reruns(spark, world):
    root, cities = world
    chunks = P.select_city_chunks(spark, cities, os.path.join(root, "chunks"), n=100, size=2)
    raw = _raw_tables(spark, chunks, days=3)
    daily = P.climate_daily(raw["climate"], raw["discharge"], chunks)
    copy, target = os.path.join(root, "copy"), os.path.join(root, "facts")
    two = P.run_window("yearly", DAY, DAY + dt.timedelta(days=1))
    load = lambda frame, **k: P.load_daily(spark, "climate", frame, two, copy, target, now=NOW, **k)
    res = load(daily, cities=cities)
    assert (res["rows"], res["outside"]) == (8, 4)
    with pytest.raises(DataQualityError, match="not in the city table"):
        load(daily, cities=cities.filter("city_id <> 11"))
    with pytest.raises(DataQualityError, match="without date or city_id"):
        load(daily.withColumn("city_id", F.when(F.col("city_id") != 11, F.col("city_id"))))
    with pytest.raises(DataQualityError, match="no rows"):
        load(daily.filter("city_id < 0"))
    # a rerun of the window with one day less: the copy holds that day alone
    load(daily.filter(F.col("date") == DAY), cities=cities)
    assert spark.read.parquet(os.path.join(copy, os.listdir(copy)[0])).select("date").distinct().count() == 1


def test_city_store_constraints_gate_bootstrap(spark, tmpdir_path):
    csv = os.path.join(tmpdir_path, "bad.csv")
    with open(csv, "w") as f:
        f.write(CSV + "E,E,,5.0,Z,ZZZ,ZZZ,,,1,16\n")  # NULL lat and a 3-letter iso2
    with pytest.raises(DataQualityError, match="lat|iso2"):
        P.bootstrap_cities(spark, csv, os.path.join(tmpdir_path, "c1"), os.path.join(tmpdir_path, "cities"))


def test_bootstrap_replace_mode(spark, world, tmpdir_path):
    root, _ = world
    csv2 = os.path.join(tmpdir_path, "worldcities3.csv")
    with open(csv2, "w") as f:
        f.write(CSV.replace("A,A,1.0,1.0", "Renamed,Renamed,1.5,1.25").replace("D,D,4.0,4.0,Y,YY,YYY,,,,15\n", ""))
    out = P.bootstrap_cities(spark, csv2, os.path.join(tmpdir_path, "clean3"), os.path.join(root, "cities"), mode="replace")
    rows = {r.city_id: r for r in out.collect()}
    assert set(rows) == {11, 12, 14} and rows[11].city == "Renamed"  # whole table replaced


def test_cli_cities_daily_backfill(spark, tmpdir_path):
    from airshed.plans import cli
    from airshed.sources.writers import write_raw_chunks

    csv = os.path.join(tmpdir_path, "worldcities.csv")
    with open(csv, "w") as f:
        f.write(CSV)
    out = os.path.join(tmpdir_path, "out")
    chunks_path = os.path.join(out, "city_chunks")
    res = cli.main(["cities", "--csv", csv, "--clean-csv", os.path.join(out, "clean"), "--cities",
                    os.path.join(out, "cities"), "--chunks", chunks_path, "--size", "2"], spark=spark)
    assert res == [{"cities": 4, "chunked": 4}]
    chunks = spark.read.parquet(chunks_path)
    raw_dir = os.path.join(tmpdir_path, "raw")
    for feed, df in _raw_tables(spark, chunks).items():
        if feed == "land_surface":
            df = df.join(chunks.select("city_id", "chunk_id"), "city_id")
        write_raw_chunks(df.withColumn("run_date", F.lit(DAY)), os.path.join(raw_dir, feed))
    res = cli.main(["daily", "--day", DAY.isoformat(), "--raw", raw_dir, "--chunks", chunks_path, "--out", out,
                    "--cities", os.path.join(out, "cities")], spark=spark)
    assert sorted(r["feed"] for r in res) == ["air_quality", "climate", "land_surface"]
    assert read_table(spark, os.path.join(out, "daily_air_quality")).count() == 4
    with pytest.raises(DataQualityError, match="no rows"):  # a day without raw rows
        cli.main(["daily", "--day", "2024-03-09", "--raw", raw_dir, "--chunks", chunks_path, "--out",
                  os.path.join(tmpdir_path, "empty"), "--feeds", "air_quality"], spark=spark)
    with pytest.raises(ValueError, match="none"):
        cli.main(["daily", "--day", DAY.isoformat(), "--raw", os.path.join(tmpdir_path, "nothing"), "--chunks", chunks_path,
                  "--out", os.path.join(tmpdir_path, "empty")], spark=spark)
    empty = os.path.join(tmpdir_path, "empty", "daily_air_quality")
    assert not any(f.endswith(".parquet") for _, _, fs in os.walk(empty) for f in fs)
    back = os.path.join(tmpdir_path, "back")
    res = cli.main(["backfill", "--start", DAY.isoformat(), "--end", (DAY + dt.timedelta(days=1)).isoformat(),
                    "--raw", raw_dir, "--chunks", chunks_path, "--out", back, "--feeds", "climate", "discharge"],
                   spark=spark)
    assert [r["feed"] for r in res] == ["climate"]
    assert read_table(spark, os.path.join(back, "daily_climate")).count() == 4
