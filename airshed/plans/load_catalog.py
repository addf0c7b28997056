"""Queries through whole loads: validated writes, versioned targets, batch
requests. The oracle SQL states bounds, columns and severities on its own; it
reads none of the objects under test."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import quality as Q
from airshed.operators.daily import AQ_SPEC, daily_aggregate
from airshed.operators.rolling import rolling_mean
from airshed.operators.series import quarantine
from airshed.plans import catalog, io_catalog, pipelines
from airshed.schemas import AIR_QUALITY_VARS
from airshed.session import delete_at_exit, ensure_utc, list_folder, move, scratch_path
from airshed.sources.batches import BatchDefinition
from airshed.sources.readers import read_stem_chunks
from airshed.sources.versioned import read_table
from airshed.sources.writers import write_csv
from airshed.streaming.incremental import RollingState

REPORT = "idx int, expectation string, `column` string, severity string, evaluated long, unexpected long, success boolean"


def _folder(spark: SparkSession, what: str) -> str:
    ensure_utc(spark)
    return io_catalog._folder(spark, what)


# ---------------------------------------------------------------------------
# The three pre-load suites, counted by the write of the transformed copy
# ---------------------------------------------------------------------------


def _validated(spark: SparkSession, daily: DataFrame, suite: list[Q.Expectation]) -> DataFrame:
    path = _folder(spark, "validated") + "/daily"
    report, _ = Q.checked_write(daily, suite, lambda rows: rows.write.partitionBy("date").parquet(path), ["date", "city_id"])
    return spark.createDataFrame([tuple(r.values()) for r in report], REPORT)


def q_aq_daily_validated(spark, sf_dir):
    """The flagship's daily frame, written once and checked by the air-quality suite as it is written."""
    events = catalog.table(spark, sf_dir, "events")
    return _validated(spark, catalog.round6(daily_aggregate(catalog.events_as_hourly(events), AQ_SPEC)), Q.AIR_QUALITY_SUITE)


def q_climate_validated(spark, sf_dir):
    """The climate frame of every embedding, checked by the climate suite as it is written."""
    return _validated(spark, catalog.q_climate_pipeline(spark, sf_dir), Q.CLIMATE_SUITE)


def q_land_surface_validated(spark, sf_dir):
    """The land-surface frame of every user, checked by its suite as it is written."""
    return _validated(spark, catalog.q_land_surface_pipeline(spark, sf_dir), Q.LAND_SURFACE_SUITE)


def _report_sql(frame: str, columns: str, checks: list[str]) -> str:
    """A report row per check: the column set, the key, then ``checks``, each
    "between COLUMN LOW HIGH" (- for none) or "pair HIGHER LOWER"."""
    wanted = ", ".join(f"('{c}')" for c in columns.split())
    rows = [
        "SELECT 0 AS idx, 'expect_table_columns_to_match_set' AS expectation, '*' AS \"column\", 'critical' AS severity,"
        f" (SELECT count(*) FROM (VALUES {wanted})) AS evaluated, (SELECT count(*) FROM (VALUES {wanted}) w(c) FULL JOIN"
        f" (SELECT column_name AS h FROM (DESCRIBE {frame})) ON c = h WHERE c IS NULL OR h IS NULL) AS unexpected",
        "SELECT 1, 'expect_compound_columns_to_be_unique', 'city_id,date', 'critical', coalesce(sum(n), 0),"
        " coalesce(sum(n) FILTER (n > 1), 0) FROM (SELECT count(*) AS n FROM f WHERE city_id IS NOT NULL OR date IS NOT NULL GROUP BY city_id, date)",
    ]
    for i, check in enumerate(checks, 2):
        kind, a, *rest = check.split()
        if kind == "between":
            low, high = rest
            bad = " OR ".join([f"{a} < {low}"] * (low != "-") + [f"{a} > {high}"] * (high != "-"))
            rows.append(f"SELECT {i}, 'expect_column_values_to_be_between', '{a}', 'critical', count({a}), count(*) FILTER ({a} IS NOT NULL AND ({bad})) FROM f")
        else:
            (b,) = rest
            rows.append(
                f"SELECT {i}, 'expect_column_pair_values_a_to_be_greater_than_b', '{a},{b}', 'warning', count(*) FILTER ({a} IS NOT NULL OR {b} IS NOT NULL),"
                f" count(*) FILTER (({a} IS NOT NULL OR {b} IS NOT NULL) AND NOT coalesce({a} >= {b}, FALSE)) FROM f"
            )
    union = "\nUNION ALL ".join(rows)
    return f"""
WITH f AS ({frame})
SELECT CAST(idx AS INTEGER) AS idx, expectation, "column", severity, CAST(evaluated AS BIGINT) AS evaluated,
       CAST(unexpected AS BIGINT) AS unexpected, unexpected = 0 AS success
FROM ({union})
"""


# Columns and bounds that the loads are checked by.
CLIMATE_CHECKED = _report_sql(
    catalog.CLIMATE_PIPELINE_SQL,
    """city_id date temperature_2m_max temperature_2m_mean temperature_2m_min relative_humidity_2m_max
    relative_humidity_2m_mean relative_humidity_2m_min cloud_cover_mean soil_moisture_0_to_10cm_mean wind_speed_10m_mean
    wind_speed_10m_max shortwave_radiation_sum precipitation_sum rain_sum snowfall_sum river_discharge pressure_msl_mean""",
    [
        "pair temperature_2m_max temperature_2m_mean", "pair temperature_2m_mean temperature_2m_min",
        "pair relative_humidity_2m_max relative_humidity_2m_mean", "pair relative_humidity_2m_mean relative_humidity_2m_min",
        "between relative_humidity_2m_max 0 100", "between relative_humidity_2m_min 0 100",
        "between relative_humidity_2m_mean 0 100", "between cloud_cover_mean 0 100",
        "between soil_moisture_0_to_10cm_mean 0 1", "between wind_speed_10m_mean 0 -", "between wind_speed_10m_max 0 -",
        "between shortwave_radiation_sum 0 -", "between soil_moisture_0_to_10cm_mean 0 -", "between precipitation_sum 0 -",
        "between rain_sum 0 -", "between snowfall_sum 0 -",
    ],
)
AIR_QUALITY_CHECKED = _report_sql(
    catalog._aq_daily_sql("city_id"),
    """city_id date pm2_5_mean pm10_mean nitrogen_dioxide_1h_max sulphur_dioxide_1h_max ozone_8h_max
    carbon_dioxide_mean carbon_monoxide_8h_max""",
    [
        "between pm2_5_mean 0 -", "between pm10_mean 0 -", "between nitrogen_dioxide_1h_max 0 -", "between sulphur_dioxide_1h_max 0 -",
        "between ozone_8h_max 0 -", "between carbon_dioxide_mean 0 -", "between carbon_monoxide_8h_max 0 -",
    ],
)
LAND_SURFACE_CHECKED = _report_sql(
    catalog._land_surface_pipeline_sql(),
    """city_id date surface_pressure total_precipitable_water sea_level_pressure land_surface_temp root_zone_soil_wetness
    surface_longwave_downward_irradiance surface_shortwave_upward_irradiance surface_longwave_upward_irradiance
    total_solar_irradiance all_sky_surface_albedo""",
    [
        "between land_surface_temp -125 80", "between total_precipitable_water 0 100", "between root_zone_soil_wetness 0 1",
        "between all_sky_surface_albedo 0 1", "between surface_pressure 500 1100", "between sea_level_pressure 500 1100",
        "between surface_longwave_downward_irradiance 0 1500", "between surface_shortwave_upward_irradiance 0 1500",
        "between surface_longwave_upward_irradiance 0 1500", "between total_solar_irradiance 0 1500",
    ],
)


def q_declared_fit(spark, sf_dir):
    """Values of line items that narrower declared types can't hold."""
    suite = [
        Q.fits("l_extendedprice", "decimal(6,2)"), Q.fits("l_extendedprice", "decimal(12,2)"), Q.fits("l_quantity", "decimal(2,1)"),
        Q.fits("l_discount", "decimal(2,2)"),
    ]
    report = Q.run_suite(catalog.table(spark, sf_dir, "lineitem"), suite)
    return report.select("idx", "column", "evaluated", "unexpected", "success")


DECLARED_FIT_SQL = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS idx, '{c}' AS \"column\", count({c}) AS evaluated,"
    f" count(*) FILTER ({c} IS NOT NULL AND abs(round({c}, {s})) >= {limit}) AS unexpected,"
    f" count(*) FILTER ({c} IS NOT NULL AND abs(round({c}, {s})) >= {limit}) = 0 AS success FROM lineitem"
    for i, (c, s, limit) in enumerate([("l_extendedprice", 2, 10_000), ("l_extendedprice", 2, 10_000_000_000), ("l_quantity", 1, 10), ("l_discount", 2, 1)])
)


# ---------------------------------------------------------------------------
# Loads
# ---------------------------------------------------------------------------


def q_cities_replace(spark, sf_dir):
    """Bulk load of a city CSV over a table that an upsert filled: the table is
    the second file's rows alone."""
    root = _folder(spark, "cities")
    key = F.col("c_custkey")
    none = F.lit(None).cast("string")
    rows = catalog.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("city"), F.col("c_name").alias("city_ascii"), (key % 97).cast("double").alias("lat"), F.col("c_nationkey").cast("double").alias("lng"),
        F.col("c_mktsegment").alias("country"), none.alias("iso2"), none.alias("iso3"), none.alias("admin_name"), none.alias("capital"),
        F.floor("c_acctbal").cast("double").alias("population"), key.cast("long").alias("id"),
    )
    for name, part in (("all", rows), ("even", rows.filter("lng % 2 = 0"))):
        write_csv(part.repartitionByRange("id").sortWithinPartitions("id"), f"{root}/{name}.csv")
    pipelines.bootstrap_cities(spark, f"{root}/all.csv", f"{root}/clean-all", f"{root}/cities")
    pipelines.bootstrap_cities(spark, f"{root}/even.csv", f"{root}/clean-even", f"{root}/cities", mode="replace")
    cities = read_table(spark, f"{root}/cities")
    return cities.select("city_id", "city", F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"), "country", "population")


CITIES_REPLACE_SQL = """
SELECT city_id, city, lat, lng, country, population FROM (
  SELECT CAST(c_custkey AS BIGINT) AS city_id, c_name AS city, CAST(c_custkey % 97 AS DOUBLE) AS lat, CAST(c_nationkey AS DOUBLE) AS lng,
         c_mktsegment AS country, CAST(floor(c_acctbal) AS BIGINT) AS population,
         row_number() OVER (PARTITION BY c_custkey % 97, c_nationkey ORDER BY c_custkey) AS r
  FROM customer WHERE c_nationkey % 2 = 0) WHERE r = 1
"""


def q_air_quality_yearly(spark, sf_dir):
    """Yearly backfill of the air-quality feed into its versioned table."""
    root = _folder(spark, "backfill")
    raw, ids = catalog._raw_from_embeddings(spark, sf_dir, AIR_QUALITY_VARS, 3600)
    pipelines.run_backfill(spark, dt.date(2024, 1, 1), dt.date(2025, 1, 1), ids, {"air_quality": raw}, root, now=io_catalog.NOW, cities=ids)
    rows = read_table(spark, f"{root}/daily_air_quality").drop("created_at")
    return rows.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in rows.dtypes])


def _air_quality_yearly_sql() -> str:
    declared = {
        "pm2_5_mean": 8, "pm10_mean": 8, "carbon_dioxide_mean": 10, "ozone_8h_max": 10, "carbon_monoxide_8h_max": 10,
        "nitrogen_dioxide_1h_max": 10, "sulphur_dioxide_1h_max": 10,
    }
    cols = ", ".join(f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL({p}, 2)) AS DOUBLE) AS {c}" for c, p in declared.items())
    return f"SELECT date, city_id, {cols} FROM ({catalog._air_quality_pipeline_sql(digits=None)}) WHERE date BETWEEN DATE '2024-01-01' AND DATE '2025-01-01'"


def q_batch_request(spark, sf_dir):
    """Files of many months, named by their first day: the requests of a year,
    of a year and a month, and of the latest batch; only their files are opened."""
    root = _folder(spark, "batches")
    orders = catalog.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("day"))
    orders.repartition("day").write.partitionBy("day").parquet(f"{root}/months")
    for name in list_folder(spark, f"{root}/months"):
        if name.startswith("day="):
            move(spark, f"{root}/months/{name}", f"{root}/months/{name[4:]}.parquet")
    months = BatchDefinition(f"{root}/months")
    last = months.latest(spark)
    out = None
    for label, request in (("year", {"year": 1996}), ("month", {"year": "1997", "month": "03"}), ("latest", dict(last.groups))):
        rows = months.read_each(spark, request, "o_orderkey long, o_custkey long").withColumn("request", F.lit(label))
        out = rows if out is None else out.unionByName(rows)
    return out


BATCH_REQUEST_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, date_trunc('month', CAST(o_orderdate AS DATE)) AS m FROM orders),
w AS (SELECT *, 'year' AS request FROM o WHERE year(m) = 1996
      UNION ALL SELECT *, 'month' FROM o WHERE m = DATE '1997-03-01'
      UNION ALL SELECT *, 'latest' FROM o WHERE m = (SELECT max(m) FROM o))
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, strftime(m, '%Y') AS year,
       strftime(m, '%m') AS month, strftime(m, '%d') AS day, request FROM w
"""


def q_stem_chunks(spark, sf_dir):
    """Raw files named by their chunk: a row's chunk id is the stem of its file."""
    root = _folder(spark, "stems")
    emb = catalog.table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("label") % 5).cast("int").alias("chunk_id"))
    emb.repartition("chunk_id").write.partitionBy("chunk_id").parquet(f"{root}/folders")
    for name in list_folder(spark, f"{root}/folders"):
        if name.startswith("chunk_id="):
            for k, file in enumerate(f for f in list_folder(spark, f"{root}/folders/{name}") if f.startswith("part-")):
                if k:
                    raise RuntimeError(f"{name} has several files")
                move(spark, f"{root}/folders/{name}/{file}", f"{root}/folders/{name[9:]}.parquet")
    files = [f"{root}/folders/{f}" for f in list_folder(spark, f"{root}/folders") if f.endswith(".parquet")]
    return read_stem_chunks(spark, files, "vec_id long, label long")


STEM_CHUNKS_SQL = "SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS BIGINT) AS label, CAST(label % 5 AS INTEGER) AS chunk_id FROM embeddings"



def q_land_surface_quarantine(spark, sf_dir):
    """Keyed bodies of which five in seven users are spoilt in a way of their
    own: the rejected ones with their reason, the others with their days."""
    root = _folder(spark, "quarantine")
    bodies = catalog.land_surface_bodies(spark, sf_dir)
    way, body = F.col("city_id") % 7, F.col("body")
    spoilt = (
        F.when(way == 0, F.expr("substring(body, 1, length(body) - 3)"))
        .when(way == 1, F.lit(" "))
        .when(way == 2, F.replace(body, F.lit("parameter"), F.lit("messages")))
        .when(way == 3, F.regexp_replace(body, r":-?[0-9.]+(E-?[0-9]+)?", ':"n/a"'))
        .when(way == 4, F.regexp_replace(body, r'"2024(\d\d)(\d\d)":', '"2024-$1-$2":'))
        .otherwise(body)
    )
    sound, rejected, counts = quarantine(bodies.withColumn("body", spoilt), f"{root}/bodies")
    days = pipelines.land_surface_daily(sound).groupBy("city_id").agg(F.count("date").alias("days"))
    total = sum(counts.values())
    kept = days.select("city_id", F.lit("ok").alias("reason"), "days", F.lit(total).cast("long").alias("bodies"))
    return kept.unionByName(rejected.select("city_id", "reason", F.lit(None).cast("long").alias("days"), F.lit(total).cast("long").alias("bodies")))


LAND_SURFACE_QUARANTINE_SQL = """
SELECT user_id AS city_id,
       CASE user_id % 7 WHEN 0 THEN 'not json' WHEN 1 THEN 'empty' WHEN 2 THEN 'no parameter' WHEN 3 THEN 'not numeric' WHEN 4 THEN 'bad day' ELSE 'ok' END AS reason,
       CASE WHEN user_id % 7 >= 5 THEN count(DISTINCT CAST(ts AS DATE)) END AS days, (SELECT count(DISTINCT user_id) FROM events) AS bodies
FROM events GROUP BY user_id
"""


def q_rolling_hot_split(spark, sf_dir):
    """Rolling means whose NULL key holds a third of the rows: the sketch finds
    it, and it is split into buckets."""
    events = catalog.table(spark, sf_dir, "events")
    keyed = events.select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("city_id"), "value")
    rolled = rolling_mean(keyed, ["value"], key="city_id", order="event_id", outputs=["value_8"], bucket_rows=512)
    return catalog.round6(rolled)


ROLLING_HOT_SPLIT_SQL = """
WITH k AS (SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN user_id END AS city_id, value FROM events)
SELECT event_id, city_id, round(value, 6) AS value,
       round(CASE WHEN count(value) OVER w = 8 THEN avg(value) OVER w END, 6) AS value_8
FROM k WINDOW w AS (PARTITION BY city_id ORDER BY event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
"""


def q_aq_daily_carried(spark, sf_dir):
    """The flagship in three runs of some days each: what a run's frames need
    of the earlier hours is carried in a versioned state table."""
    root = _folder(spark, "carried")
    hours = catalog.events_as_hourly(catalog.table(spark, sf_dir, "events"))
    state = RollingState(f"{root}/state", lambda rows: rows)
    cuts = [None, dt.date(2024, 1, 9), dt.date(2024, 1, 20), None]
    out = None
    for run, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        inside = (F.lit(True) if lo is None else F.col("date") >= F.lit(lo)) & (F.lit(True) if hi is None else F.col("date") < F.lit(hi))
        batch, carried = hours.filter(inside), state.carried(spark, run)
        daily = daily_aggregate(batch, AQ_SPEC, carried=carried)
        state.carry(spark, run, batch, carried)
        out = daily if out is None else out.unionByName(daily)
    return catalog.round6(out)


QUERIES = {
    "aq_daily_validated": q_aq_daily_validated,
    "climate_validated": q_climate_validated,
    "land_surface_validated": q_land_surface_validated,
    "declared_fit": q_declared_fit,
    "cities_replace": q_cities_replace,
    "air_quality_yearly": q_air_quality_yearly,
    "batch_request": q_batch_request,
    "stem_chunks": q_stem_chunks,
    "land_surface_quarantine": q_land_surface_quarantine,
    "rolling_hot_split": q_rolling_hot_split,
    "aq_daily_carried": q_aq_daily_carried,
}

ORACLE_SQL = {
    "aq_daily_validated": AIR_QUALITY_CHECKED,
    "climate_validated": CLIMATE_CHECKED,
    "land_surface_validated": LAND_SURFACE_CHECKED,
    "declared_fit": DECLARED_FIT_SQL,
    "cities_replace": CITIES_REPLACE_SQL,
    "air_quality_yearly": _air_quality_yearly_sql(),
    "batch_request": BATCH_REQUEST_SQL,
    "stem_chunks": STEM_CHUNKS_SQL,
    "land_surface_quarantine": LAND_SURFACE_QUARANTINE_SQL,
    "rolling_hot_split": ROLLING_HOT_SPLIT_SQL,
    "aq_daily_carried": catalog._aq_daily_sql("city_id"),
}
