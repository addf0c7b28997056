"""Query catalogue on the driver tables (feeds ``queries()``/``oracle_sql()``).

The driver tables hold no weather data, so each operator runs on an analogue
over whole tables: ``events.user_id`` is the city, ``events.ts`` the hour and
``events.value`` split by ``event_type`` the pollutants; ``customer`` plays the
city dimension, ``orders`` the daily facts, ``embeddings`` the series feed.

Every query returns a DataFrame; the oracle is DuckDB SQL over the same
parquet files. Doubles are rounded to 6 places on both sides (summation order
differs between engines), keys are BIGINT, days are DATE.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.clean import null_sentinel, quantize
from airshed.functions.period import in_window, run_window
from airshed.functions.timecols import batch_params
from airshed.operators import quality as Q
from airshed.operators.cities import (
    assign_chunks,
    dedup_first,
    request_batches,
    scan_position,
    top_cities,
    top_cities_sql,
)
from airshed.operators.combine import outer_combine, union_chunks
from airshed.operators.daily import AQ_SPEC, Metric, daily_aggregate
from airshed.operators.quality import orphans, run_suite
from airshed.operators.rolling import rolling_mean
from airshed.operators.series import explode_series, join_discharge, pivot_keyed_series, zip_positional
from airshed.operators.upsert import upsert
from airshed.plans import io_catalog
from airshed.plans.pipelines import air_quality_daily, climate_daily, land_surface_daily
from airshed.schemas import (
    AIR_QUALITY_VARS,
    CLIMATE_VARS,
    DISCHARGE_VARS,
    LAND_SURFACE_RENAME,
    LAND_SURFACE_VARS,
)
from airshed.session import ensure_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round6(df: DataFrame) -> DataFrame:
    """Compare hygiene: doubles to 6 places; session-zone timestamps as UTC
    wall-clock ``timestamp_ntz`` (the session is UTC, see ``table``)."""

    def fix(f):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f.name), 6).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[fix(f) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Air quality on events: user = city, ts = hour, value by event_type = pollutant
# ---------------------------------------------------------------------------


def events_as_hourly(events: DataFrame) -> DataFrame:
    v, t = F.col("value"), F.col("event_type")
    return events.select(
        F.col("ts").alias("date"),
        F.col("user_id").alias("city_id"),
        F.when(t.isin("view", "click"), v).alias("pm2_5"),
        v.alias("pm10"),
        F.when(t == "purchase", v).alias("carbon_dioxide"),
        v.alias("ozone"),
        F.when(t != "error", v / 10).alias("carbon_monoxide"),
        F.when(t == "error", v).alias("nitrogen_dioxide"),
        F.when(t == "signup", v).alias("sulphur_dioxide"),
    )


HOURLY_SQL = """
  SELECT ts AS date, user_id AS city_id,
         CASE WHEN event_type IN ('view', 'click') THEN value END AS pm2_5,
         value AS pm10,
         CASE WHEN event_type = 'purchase' THEN value END AS carbon_dioxide,
         value AS ozone,
         CASE WHEN event_type <> 'error' THEN value / 10 END AS carbon_monoxide,
         CASE WHEN event_type = 'error' THEN value END AS nitrogen_dioxide,
         CASE WHEN event_type = 'signup' THEN value END AS sulphur_dioxide
  FROM events
  WHERE user_id IS NOT NULL AND ts IS NOT NULL
"""


def _aq_daily_sql(partition: str) -> str:
    return f"""
WITH h AS ({HOURLY_SQL}),
r AS (
  SELECT *,
    CASE WHEN count(ozone) OVER w = 8 THEN avg(ozone) OVER w END AS o3_8h,
    CASE WHEN count(carbon_monoxide) OVER w = 8 THEN avg(carbon_monoxide) OVER w END AS co_8h
  FROM h
  WINDOW w AS (PARTITION BY {partition} ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
)
SELECT CAST(city_id AS BIGINT) AS city_id, CAST(date AS DATE) AS date,
  round(avg(pm2_5), 6) AS pm2_5_mean,
  round(avg(pm10), 6) AS pm10_mean,
  round(avg(carbon_dioxide), 6) AS carbon_dioxide_mean,
  round(max(o3_8h), 6) AS ozone_8h_max,
  round(max(co_8h), 6) AS carbon_monoxide_8h_max,
  round(max(nitrogen_dioxide), 6) AS nitrogen_dioxide_1h_max,
  round(max(sulphur_dioxide), 6) AS sulphur_dioxide_1h_max
FROM r GROUP BY city_id, CAST(date AS DATE)
"""


def q_aq_daily(spark, sf_dir):
    hourly = events_as_hourly(table(spark, sf_dir, "events"))
    return round6(daily_aggregate(hourly, AQ_SPEC))


def q_aq_daily_reset(spark, sf_dir):
    hourly = events_as_hourly(table(spark, sf_dir, "events"))
    return round6(daily_aggregate(hourly, AQ_SPEC, reset_daily=True))


def q_rolling_mean_8(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = rolling_mean(ev, ["value"], key="user_id", order="ts", rows=8, outputs=["value_8h"])
    return round6(out.select("event_id", "user_id", "ts", "value_8h"))


def q_rolling_mean_8_gaps(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )
    out = rolling_mean(ev, ["v"], key="user_id", order="ts", rows=8, outputs=["v_8h"])
    return round6(out.select("event_id", "user_id", "ts", "v_8h"))


ROLLING_SQL = """
SELECT event_id, user_id, ts,
  round(CASE WHEN count({c}) OVER w = 8 THEN avg({c}) OVER w END, 6) AS {out}
FROM (SELECT event_id, user_id, ts, {expr} AS {c} FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
"""

DAILY_MEAN_SPEC = (
    Metric("pm2_5_mean", "pm2_5", "mean"),
    Metric("pm10_mean", "pm10", "mean"),
    Metric("carbon_dioxide_mean", "carbon_dioxide", "mean"),
)
DAILY_MAX_SPEC = (
    Metric("nitrogen_dioxide_1h_max", "nitrogen_dioxide", "max"),
    Metric("sulphur_dioxide_1h_max", "sulphur_dioxide", "max"),
)


def q_daily_mean(spark, sf_dir):
    return round6(daily_aggregate(events_as_hourly(table(spark, sf_dir, "events")), DAILY_MEAN_SPEC))


def q_daily_max(spark, sf_dir):
    return round6(daily_aggregate(events_as_hourly(table(spark, sf_dir, "events")), DAILY_MAX_SPEC))


DAILY_MEAN_SQL = f"""
WITH h AS ({HOURLY_SQL})
SELECT CAST(city_id AS BIGINT) AS city_id, CAST(date AS DATE) AS date,
  round(avg(pm2_5), 6) AS pm2_5_mean, round(avg(pm10), 6) AS pm10_mean,
  round(avg(carbon_dioxide), 6) AS carbon_dioxide_mean
FROM h GROUP BY city_id, CAST(date AS DATE)
"""

DAILY_MAX_SQL = f"""
WITH h AS ({HOURLY_SQL})
SELECT CAST(city_id AS BIGINT) AS city_id, CAST(date AS DATE) AS date,
  round(max(nitrogen_dioxide), 6) AS nitrogen_dioxide_1h_max,
  round(max(sulphur_dioxide), 6) AS sulphur_dioxide_1h_max
FROM h GROUP BY city_id, CAST(date AS DATE)
"""


def q_outer_combine(spark, sf_dir):
    """One aggregate per event type, key sets differ, combined on (user, day)."""
    ev = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))

    def per(kind, agg):
        return ev.filter(F.col("event_type") == kind).groupBy("user_id", "date").agg(agg)

    combined = outer_combine(
        [
            per("click", F.avg("value").alias("click_mean")),
            per("error", F.max("value").alias("error_max")),
            per("purchase", F.count(F.lit(1)).alias("purchase_n")),
            per("view", F.min("value").alias("view_min")),
            per("signup", F.sum("value").alias("signup_sum")),
        ],
        ["user_id", "date"],
    )
    return round6(combined)


OUTER_COMBINE_SQL = """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS date, event_type, value FROM events),
a AS (SELECT user_id, date, avg(value) AS click_mean FROM e WHERE event_type = 'click' GROUP BY ALL),
b AS (SELECT user_id, date, max(value) AS error_max FROM e WHERE event_type = 'error' GROUP BY ALL),
c AS (SELECT user_id, date, count(*) AS purchase_n FROM e WHERE event_type = 'purchase' GROUP BY ALL),
d AS (SELECT user_id, date, min(value) AS view_min FROM e WHERE event_type = 'view' GROUP BY ALL),
f AS (SELECT user_id, date, sum(value) AS signup_sum FROM e WHERE event_type = 'signup' GROUP BY ALL)
SELECT CAST(user_id AS BIGINT) AS user_id, date, round(click_mean, 6) AS click_mean,
       round(error_max, 6) AS error_max, CAST(purchase_n AS BIGINT) AS purchase_n,
       round(view_min, 6) AS view_min, round(signup_sum, 6) AS signup_sum
FROM a FULL JOIN b USING (user_id, date) FULL JOIN c USING (user_id, date)
  FULL JOIN d USING (user_id, date) FULL JOIN f USING (user_id, date)
"""


# ---------------------------------------------------------------------------
# City dimension on customer: dedup, top-k, head, chunks, request batches
# ---------------------------------------------------------------------------

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def q_city_dedup(spark, sf_dir):
    """Keep the first customer (file order) per (nation, segment)."""
    cust = scan_position(table(spark, sf_dir, "customer"))
    return round6(dedup_first(cust, ["c_nationkey", "c_mktsegment"], "_pos").drop("_pos"))


CITY_DEDUP_SQL = """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment
FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn
      FROM customer)
WHERE rn = 1
"""


def q_city_topk(spark, sf_dir):
    """Top 100 of one segment by balance (bound parameter, NULLs last, ties by key)."""
    cust = table(spark, sf_dir, "customer")
    top = top_cities(
        cust, country="BUILDING", n=100, by="c_acctbal", key="c_custkey",
        cols=("c_custkey", "c_nationkey", "c_acctbal"), country_col="c_mktsegment",
    )
    return round6(top)


CITY_TOPK_SQL = """
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal FROM customer
WHERE c_mktsegment = 'BUILDING'
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100
"""


def q_city_topk_sql(spark, sf_dir):
    """The top-k as SQL text with bound parameters over the customer table."""
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("city_id"), F.col("c_nationkey").alias("lat"), F.col("c_acctbal").alias("lng"),
        F.col("c_mktsegment").alias("country"), F.col("c_acctbal").alias("population"),
    )
    return round6(top_cities_sql(spark, cust, "MACHINERY", 100))


CITY_TOPK_SQL_SQL = """
SELECT c_custkey AS city_id, c_nationkey AS lat, round(c_acctbal, 6) AS lng FROM customer
WHERE c_mktsegment = 'MACHINERY'
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 100
"""


def q_city_head(spark, sf_dir):
    """First 100 by key (the unordered head made deterministic)."""
    cust = table(spark, sf_dir, "customer")
    return round6(top_cities(cust, n=100, by=None, key="c_custkey", cols=("c_custkey", "c_nationkey", "c_acctbal")))


CITY_HEAD_SQL = """
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal FROM customer ORDER BY c_custkey LIMIT 100
"""


def _customer_chunks(spark, sf_dir, size=50):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return assign_chunks(cust, ["c_custkey"], size=size)


def q_chunk_assign(spark, sf_dir):
    return round6(_customer_chunks(spark, sf_dir))


CHUNK_ASSIGN_SQL = """
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal,
       CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS INTEGER) AS chunk_id,
       CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 50 AS INTEGER) AS pos
FROM customer
"""


def q_request_batches(spark, sf_dir):
    return request_batches(_customer_chunks(spark, sf_dir), cols=("c_custkey", "c_nationkey"))


REQUEST_BATCHES_SQL = """
WITH c AS (
  SELECT c_custkey, c_nationkey,
         CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS INTEGER) AS chunk_id,
         (row_number() OVER (ORDER BY c_custkey) - 1) % 50 AS pos
  FROM customer)
SELECT chunk_id, count(*) AS n,
       string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY pos) AS c_custkey_list,
       string_agg(CAST(c_nationkey AS VARCHAR), ',' ORDER BY pos) AS c_nationkey_list
FROM c GROUP BY chunk_id
"""


# ---------------------------------------------------------------------------
# Series feeds: embeddings as vectors with a time header; positional zip
# ---------------------------------------------------------------------------

SERIES_EPOCH = 1704067200  # 2024-01-01T00:00:00Z


def q_series_explode(spark, sf_dir):
    """Each embedding is one response: hourly steps from a label-dependent start."""
    emb = table(spark, sf_dir, "embeddings")
    raw = emb.select(
        "vec_id",
        (F.lit(SERIES_EPOCH) + F.col("label").cast("long") * 86400).alias("start_s"),
        (F.lit(SERIES_EPOCH) + F.col("label").cast("long") * 86400 + F.size("embedding").cast("long") * 3600).alias("end_s"),
        F.lit(3600).alias("interval_s"),
        F.col("embedding").alias("v"),
    )
    rows = explode_series(raw, ["v"], keys=("vec_id",))
    return round6(rows.withColumn("date", F.col("date").cast("timestamp_ntz")))


SERIES_EXPLODE_SQL = f"""
SELECT vec_id,
       make_timestamp(CAST(({SERIES_EPOCH} + label * 86400 + i * 3600) AS BIGINT) * 1000000) AS date,
       round(CAST(embedding[i + 1] AS DOUBLE), 6) AS v
FROM embeddings, range(CAST(len(embedding) AS BIGINT)) t(i)
"""


def q_positional_zip(spark, sf_dir):
    """Ids in chunks of 50 zipped with responses in chunks of 40 (shorter side wins)."""
    ids = _customer_chunks(spark, sf_dir).select("chunk_id", "pos", "c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    responses = assign_chunks(orders, ["o_orderkey"], size=40)
    return round6(zip_positional(ids, responses))


POSITIONAL_ZIP_SQL = """
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS g FROM customer),
o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS g FROM orders)
SELECT CAST(c.g // 50 AS INTEGER) AS chunk_id, CAST(c.g % 50 AS INTEGER) AS pos, c_custkey, o_orderkey,
       round(o_totalprice, 6) AS o_totalprice
FROM c JOIN o ON c.g // 50 = o.g // 40 AND c.g % 50 = o.g % 40
"""


def q_keyed_json_pivot(spark, sf_dir):
    """Per user, a keyed JSON body {type: {yyyymmdd: daily sum}} built by Spark
    from events, then pivoted back to one row per (user, day)."""
    ev = table(spark, sf_dir, "events")
    per_day = ev.groupBy("user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("d")).agg(
        F.sum("value").alias("v")
    )
    per_var = per_day.groupBy("user_id", "event_type").agg(
        F.map_from_entries(F.collect_list(F.struct("d", "v"))).alias("m")
    )
    bodies = per_var.groupBy("user_id").agg(
        F.to_json(
            F.struct(
                F.struct(F.map_from_entries(F.collect_list(F.struct("event_type", "m"))).alias("parameter")).alias(
                    "properties"
                )
            )
        ).alias("body")
    )
    wide = pivot_keyed_series(bodies, EVENT_TYPES, keys=("user_id",))
    return round6(wide)


EVENT_TYPES = ["click", "error", "view", "signup", "purchase"]

KEYED_JSON_PIVOT_SQL = """
SELECT CAST(ts AS DATE) AS date,
""" + ",\n".join(
    f"  round(sum(CASE WHEN event_type = '{t}' THEN value END), 6) AS {t}" for t in EVENT_TYPES
) + """,
  user_id
FROM events GROUP BY user_id, CAST(ts AS DATE)
"""


# ---------------------------------------------------------------------------
# Run windows on orders
# ---------------------------------------------------------------------------

ORDER_DAY = dt.date(1997, 5, 28)


def _orders_in(spark, sf_dir, window):
    o = table(spark, sf_dir, "orders")
    return round6(
        o.filter(in_window("o_orderdate", window)).select(
            "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("date")
        )
    )


def q_period_daily(spark, sf_dir):
    return _orders_in(spark, sf_dir, run_window("daily", ORDER_DAY))


def q_period_yearly(spark, sf_dir):
    return _orders_in(spark, sf_dir, run_window("yearly", dt.date(1997, 1, 1), dt.date(1998, 1, 1)))


def q_period_lag(spark, sf_dir):
    return _orders_in(spark, sf_dir, run_window("daily", ORDER_DAY, lag_days=1))


def _period_sql(lo: str, hi: str) -> str:
    return f"""
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'
"""


# ---------------------------------------------------------------------------
# Joins / unions / cleaning
# ---------------------------------------------------------------------------


def _day_totals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    climate = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.sum("o_totalprice").alias("orders_total"), F.count(F.lit(1)).alias("n_orders")
    )
    discharge = lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_extendedprice").alias("shipped_total")
    )
    return climate, discharge


def q_climate_join_discharge(spark, sf_dir):
    climate, discharge = _day_totals(spark, sf_dir)
    return round6(join_discharge(climate, discharge, keys=("date",), how="inner"))


def q_climate_join_discharge_left(spark, sf_dir):
    climate, discharge = _day_totals(spark, sf_dir)
    return round6(join_discharge(climate, discharge, keys=("date",), how="left"))


def _join_discharge_sql(how: str) -> str:
    return f"""
WITH c AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS orders_total, count(*) AS n_orders
           FROM orders GROUP BY 1),
d AS (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) AS shipped_total FROM lineitem GROUP BY 1)
SELECT c.date, round(orders_total, 6) AS orders_total, n_orders, round(shipped_total, 6) AS shipped_total
FROM c {how} JOIN d ON c.date = d.date
"""


def q_chunk_union(spark, sf_dir):
    """Three chunks of orders with different column sets, stacked by name."""
    o = table(spark, sf_dir, "orders")
    parts = [
        o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"),
        o.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("date")),
        o.filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date")),
        o.filter(~F.col("o_orderstatus").isin("F", "O", "P") | F.col("o_orderstatus").isNull()).select("o_orderkey"),
    ]
    return round6(union_chunks(parts))


CHUNK_UNION_SQL = """
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, NULL::DATE AS date FROM orders WHERE o_orderstatus = 'F'
UNION ALL BY NAME
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderstatus = 'O'
UNION ALL BY NAME
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderstatus = 'P'
UNION ALL BY NAME
SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P') OR o_orderstatus IS NULL
"""


def q_sentinel_null(spark, sf_dir):
    """``p_size = 11`` plays the -999 sentinel: NULL in every numeric column but the key."""
    return round6(null_sentinel(table(spark, sf_dir, "part"), value=11, exclude=("p_partkey",)))


SENTINEL_NULL_SQL = """
SELECT p_partkey, p_name, p_brand, p_type, NULLIF(p_size, 11) AS p_size,
       round(NULLIF(p_retailprice, 11), 6) AS p_retailprice
FROM part
"""

PART_RENAME = {"p_partkey": "part_id", "p_name": "name", "p_brand": "brand", "p_size": "size", "p_retailprice": "retail_price"}


def q_rename_coded(spark, sf_dir):
    return round6(table(spark, sf_dir, "part").withColumnsRenamed(PART_RENAME))


RENAME_CODED_SQL = """
SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type, p_size AS size,
       round(p_retailprice, 6) AS retail_price
FROM part
"""


def q_quantize_2(spark, sf_dir):
    """Line revenue and tax quantised to 0.01 (HALF_UP on the shortest decimal text)."""
    li = table(spark, sf_dir, "lineitem")
    q = li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
    )
    q = quantize(q, {"revenue": T.DecimalType(18, 2), "tax": T.DecimalType(18, 2)})
    return q.select("l_orderkey", "l_linenumber", F.col("revenue").cast("double"), F.col("tax").cast("double"))


QUANTIZE_2_SQL = """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(18, 2)) AS DOUBLE) AS revenue,
  CAST(CAST(CAST(l_extendedprice * l_tax AS VARCHAR) AS DECIMAL(18, 2)) AS DOUBLE) AS tax
FROM lineitem
"""


# ---------------------------------------------------------------------------
# Upserts (injected clock; created_at never compared against wall time)
# ---------------------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 6, 1)


def q_upsert_full(spark, sf_dir):
    """Target = orders F/O, source = orders O/P with new prices (NULL overwrites)."""
    o = table(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), "o_custkey", "o_totalprice", "o_orderpriority",
        F.lit(T0).alias("created_at"),
    )
    source = o.filter(F.col("o_orderstatus").isin("O", "P")).select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("o_custkey"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
    )
    return round6(upsert(target, source, ["o_orderkey", "date"], now=NOW))


UPSERT_FULL_SQL = """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_custkey, o_totalprice, o_orderpriority,
                  TIMESTAMP '2024-01-01 00:00:00' AS created_at
           FROM orders WHERE o_orderstatus IN ('F', 'O')),
s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
             CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey,
             o_totalprice + 1 AS o_totalprice
      FROM orders WHERE o_orderstatus IN ('O', 'P'))
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, COALESCE(t.date, s.date) AS date,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       round(CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END, 6) AS o_totalprice,
       t.o_orderpriority AS o_orderpriority,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.created_at ELSE TIMESTAMP '2024-06-01 00:00:00' END AS created_at
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.date = s.date
"""


def q_upsert_narrow(spark, sf_dir):
    """Only the balance (``lat``/``lng`` analogue) of a matched customer changes;
    its name stays; new customers come in whole."""
    c = table(spark, sf_dir, "customer")
    target = c.filter(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY"))
    source = c.filter(F.col("c_mktsegment").isin("MACHINERY", "HOUSEHOLD", "FURNITURE")).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_mktsegment",
    )
    return round6(upsert(target, source, ["c_custkey"], update_cols=["c_acctbal"], created_col=None))


UPSERT_NARROW_SQL = """
WITH t AS (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')),
s AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment
      FROM customer WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD', 'FURNITURE'))
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE s.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey,
       round(CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END, 6) AS c_acctbal,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM t FULL JOIN s ON t.c_custkey = s.c_custkey
"""


# ---------------------------------------------------------------------------
# Data quality on lineitem / orders / customer
# ---------------------------------------------------------------------------

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
DQ_UNIQUE = [Q.compound_unique(["l_orderkey", "l_linenumber"])]
DQ_BETWEEN = [
    Q.between("l_discount", 0, 0.1),
    Q.between("l_tax", 0, 0.06),
    Q.between("l_quantity", 1, 50),
    Q.between("l_quantity", 10, 40, mostly=0.5),
]
DQ_PAIR = [
    Q.pair_ge("l_extendedprice", "l_quantity", severity=Q.WARNING),
    Q.pair_ge("l_tax", "l_discount", severity=Q.WARNING),
    Q.pair_ge("l_tax", "l_discount", or_equal=False, mostly=0.4, severity=Q.WARNING),
]
DQ_LOWER = [Q.between("l_extendedprice", 0, None), Q.between("l_discount", 0.02, None)]
DQ_SUITE = [Q.columns_match_set(LINEITEM_COLUMNS + ["l_comment"]), *DQ_UNIQUE, *DQ_PAIR, *DQ_BETWEEN, *DQ_LOWER]
DQ_STORE = [
    Q.not_null("c_name"),
    Q.not_null("c_mktsegment"),
    Q.compound_unique(["c_custkey"]),
    Q.max_length("c_name", 18),
    Q.max_length("c_mktsegment", 9),
]


def _dq(spark, sf_dir, name, suite):
    return run_suite(table(spark, sf_dir, name), suite)


def q_dq_unique(spark, sf_dir):
    return _dq(spark, sf_dir, "lineitem", DQ_UNIQUE)


def q_dq_between(spark, sf_dir):
    return _dq(spark, sf_dir, "lineitem", DQ_BETWEEN)


def q_dq_pair(spark, sf_dir):
    return _dq(spark, sf_dir, "lineitem", DQ_PAIR)


def q_dq_lower(spark, sf_dir):
    return _dq(spark, sf_dir, "lineitem", DQ_LOWER)


def q_dq_suite(spark, sf_dir):
    return _dq(spark, sf_dir, "lineitem", DQ_SUITE)


def q_not_null_length(spark, sf_dir):
    return _dq(spark, sf_dir, "customer", DQ_STORE)


def _sql_lit(x) -> str:
    return "NULL" if x is None else repr(float(x))


def suite_sql(tbl: str, suite, columns: list[str]) -> str:
    """Oracle for ``run_suite``: one SELECT per expectation, UNION ALL."""
    parts = []
    for i, e in enumerate(suite):
        head = f"{i} AS idx, '{e.name}' AS expectation, '{e.label}' AS \"column\", '{e.severity}' AS severity"
        if e.kind == "columns_match_set":
            want = set(e.columns)
            ev, un = len(want), len(want ^ set(columns))
            body = f"SELECT {head}, CAST({ev} AS BIGINT) AS evaluated, CAST({un} AS BIGINT) AS unexpected"
        elif e.kind == "compound_unique":
            cols = ", ".join(e.columns)
            some = " OR ".join(f"{c} IS NOT NULL" for c in e.columns)
            body = (
                f"SELECT {head}, CAST(coalesce(sum(n), 0) AS BIGINT) AS evaluated, "
                f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected "
                f"FROM (SELECT {cols}, count(*) AS n FROM {tbl} WHERE {some} GROUP BY {cols})"
            )
        elif e.kind == "between":
            c = e.columns[0]
            bad = " OR ".join(
                x for x in ([f"{c} < {_sql_lit(e.lo)}"] if e.lo is not None else [])
                + ([f"{c} > {_sql_lit(e.hi)}"] if e.hi is not None else [])
            ) or "FALSE"
            body = (
                f"SELECT {head}, count({c}) AS evaluated, "
                f"count(*) FILTER (WHERE {c} IS NOT NULL AND ({bad})) AS unexpected FROM {tbl}"
            )
        elif e.kind == "pair_ge":
            a, b = e.columns
            op = ">=" if e.or_equal else ">"
            seen = f"({a} IS NOT NULL OR {b} IS NOT NULL)"
            body = (
                f"SELECT {head}, count(*) FILTER (WHERE {seen}) AS evaluated, "
                f"count(*) FILTER (WHERE {seen} AND NOT coalesce({a} {op} {b}, FALSE)) AS unexpected FROM {tbl}"
            )
        elif e.kind == "not_null":
            c = e.columns[0]
            body = f"SELECT {head}, count(*) AS evaluated, count(*) FILTER (WHERE {c} IS NULL) AS unexpected FROM {tbl}"
        elif e.kind == "max_length":
            c = e.columns[0]
            body = (
                f"SELECT {head}, count({c}) AS evaluated, "
                f"count(*) FILTER (WHERE length({c}) > {int(e.hi)}) AS unexpected FROM {tbl}"
            )
        else:
            raise ValueError(e.kind)
        parts.append(f"SELECT *, {e.mostly!r} AS mostly FROM ({body})")
    union = "\nUNION ALL\n".join(parts)
    return f"""
SELECT CAST(idx AS INTEGER) AS idx, expectation, "column", severity,
       CAST(evaluated AS BIGINT) AS evaluated, CAST(unexpected AS BIGINT) AS unexpected,
       (evaluated = 0 OR (evaluated - unexpected) / evaluated >= mostly) AS success
FROM ({union})
"""


def q_fk_orphans(spark, sf_dir):
    """Line items whose order is not among the finished orders."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    finished = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return round6(orphans(li, finished, key="l_orderkey", dim_key="o_orderkey"))


FK_ORPHANS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity, 6) AS l_quantity FROM lineitem l
WHERE l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
"""

BATCH_DAY = dt.date(2024, 1, 15)


def q_batch_pick(spark, sf_dir):
    """One day's batch of events, with its zero-padded batch parameters."""
    ev = table(spark, sf_dir, "events")
    day = ev.filter(in_window("ts", run_window("daily", BATCH_DAY)))
    return round6(day.select("event_id", "user_id", "ts", "value", *batch_params(F.to_date("ts"))))


BATCH_PICK_SQL = """
SELECT event_id, user_id, ts, round(value, 6) AS value,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
"""


def q_quantize_declared(spark, sf_dir):
    """Measures quantised to their declared (precision, scale), HALF_UP."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    q = quantize(li, DECLARED)
    return q.select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in DECLARED])


DECLARED = {
    "l_extendedprice": T.DecimalType(12, 2),
    "l_discount": T.DecimalType(6, 1),
    "l_tax": T.DecimalType(5, 3),
}

QUANTIZE_DECLARED_SQL = """
SELECT l_orderkey, l_linenumber,
  CAST(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(12, 2)) AS DOUBLE) AS l_extendedprice,
  CAST(CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(6, 1)) AS DOUBLE) AS l_discount,
  CAST(CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(5, 3)) AS DOUBLE) AS l_tax
FROM lineitem
"""


# ---------------------------------------------------------------------------
# The per-feed pipeline functions on whole tables: embeddings as raw series
# responses (chunks from assign_chunks), events as keyed land-surface bodies
# ---------------------------------------------------------------------------

EMB_LEN = 64  # every embedding has 64 values (checked by the strict explode)


def _raw_from_embeddings(spark, sf_dir, variables, interval_s):
    """One raw response per embedding: chunk/pos from the city ids in id order,
    a label-dependent start, and the vector (or its reverse) per variable."""
    emb = table(spark, sf_dir, "embeddings")
    ids = assign_chunks(emb.select(F.col("vec_id").alias("city_id")), ["city_id"], size=50)
    start = F.lit(SERIES_EPOCH) + F.col("label").cast("long") * 86400
    raw = emb.join(ids, emb["vec_id"] == ids["city_id"]).select(
        "chunk_id", "pos", start.alias("start_s"),
        (start + F.size("embedding").cast("long") * interval_s).alias("end_s"),
        F.lit(interval_s).alias("interval_s"),
        *[(F.col("embedding") if i % 2 == 0 else F.reverse("embedding")).alias(v) for i, v in enumerate(variables)],
    )
    return raw, ids


def _series_value_sql(i: int) -> str:
    return "embedding[i + 1]" if i % 2 == 0 else f"embedding[{EMB_LEN} - i]"


def q_climate_pipeline(spark, sf_dir):
    raw, ids = _raw_from_embeddings(spark, sf_dir, [*CLIMATE_VARS, *DISCHARGE_VARS], 86400)
    raw_climate = raw.drop(*DISCHARGE_VARS)
    raw_discharge = raw.drop(*CLIMATE_VARS).withColumn(DISCHARGE_VARS[0], F.reverse(DISCHARGE_VARS[0]))
    return round6(climate_daily(raw_climate, raw_discharge, ids))


CLIMATE_PIPELINE_SQL = (
    f"SELECT CAST(make_timestamp(CAST(({SERIES_EPOCH} + label * 86400 + i * 86400) AS BIGINT) * 1000000) AS DATE)"
    " AS date, vec_id AS city_id,\n"
    + ",\n".join(f"  round(CAST({_series_value_sql(k)} AS DOUBLE), 6) AS {v}" for k, v in enumerate(CLIMATE_VARS))
    + ",\n  round(CAST(embedding[i + 1] AS DOUBLE), 6) AS river_discharge\n"
    + "FROM embeddings, range(CAST(len(embedding) AS BIGINT)) t(i)"
)


def q_air_quality_pipeline(spark, sf_dir):
    raw_air, ids = _raw_from_embeddings(spark, sf_dir, AIR_QUALITY_VARS, 3600)
    return round6(air_quality_daily(raw_air, ids))


def _air_quality_pipeline_sql(digits: int | None = 6) -> str:
    rounded = (lambda x: x) if digits is None else (lambda x: f"round({x}, {digits})")
    cols = ",\n".join(
        f"    CAST({_series_value_sql(k)} AS DOUBLE) AS {v}" for k, v in enumerate(AIR_QUALITY_VARS)
    )
    return f"""
WITH h AS (
  SELECT vec_id AS city_id,
    make_timestamp(CAST(({SERIES_EPOCH} + label * 86400 + i * 3600) AS BIGINT) * 1000000) AS date,
{cols}
  FROM embeddings, range(CAST(len(embedding) AS BIGINT)) t(i)),
r AS (
  SELECT *,
    CASE WHEN count(ozone) OVER w = 8 THEN avg(ozone) OVER w END AS o3_8h,
    CASE WHEN count(carbon_monoxide) OVER w = 8 THEN avg(carbon_monoxide) OVER w END AS co_8h
  FROM h WINDOW w AS (PARTITION BY city_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT city_id, CAST(date AS DATE) AS date,
  {rounded('avg(pm2_5)')} AS pm2_5_mean, {rounded('avg(pm10)')} AS pm10_mean,
  {rounded('avg(carbon_dioxide)')} AS carbon_dioxide_mean, {rounded('max(o3_8h)')} AS ozone_8h_max,
  {rounded('max(co_8h)')} AS carbon_monoxide_8h_max, {rounded('max(nitrogen_dioxide)')} AS nitrogen_dioxide_1h_max,
  {rounded('max(sulphur_dioxide)')} AS sulphur_dioxide_1h_max
FROM r GROUP BY city_id, CAST(date AS DATE)
"""


# event type -> coded land-surface variable (the other five stay absent -> NULL)
LAND_CODES = {"click": "PS", "error": "TS", "view": "TQV", "signup": "SLP", "purchase": "GWETROOT"}


def land_surface_bodies(spark, sf_dir):
    """Per user, a keyed JSON body {CODE: {yyyymmdd: daily sum, or -999 on days
    with 3+ events of that type}} built from events."""
    ev = table(spark, sf_dir, "events")
    code = F.create_map(*[x for k, v in LAND_CODES.items() for x in (F.lit(k), F.lit(v))])[F.col("event_type")]
    per_day = ev.groupBy(F.col("user_id").alias("city_id"), code.alias("var"), F.date_format("ts", "yyyyMMdd").alias("d")).agg(
        F.when(F.count(F.lit(1)) >= 3, F.lit(-999.0)).otherwise(F.sum("value")).alias("v")
    )
    per_var = per_day.groupBy("city_id", "var").agg(F.map_from_entries(F.collect_list(F.struct("d", "v"))).alias("m"))
    return per_var.groupBy("city_id").agg(
        F.to_json(
            F.struct(F.struct(F.map_from_entries(F.collect_list(F.struct("var", "m"))).alias("parameter")).alias("properties"))
        ).alias("body")
    )


def q_land_surface_pipeline(spark, sf_dir):
    """The land-surface transform of every user's body: pivot, descriptive
    names, -999 -> NULL."""
    return round6(land_surface_daily(land_surface_bodies(spark, sf_dir)))


def _land_surface_pipeline_sql() -> str:
    cols = []
    for coded in LAND_SURFACE_VARS:
        out = LAND_SURFACE_RENAME[coded]
        types = [t for t, c in LAND_CODES.items() if c == coded]
        if types:
            t = types[0]
            cols.append(
                f"  round(CASE WHEN count(*) FILTER (WHERE event_type = '{t}') >= 3 THEN NULL"
                f" ELSE sum(value) FILTER (WHERE event_type = '{t}') END, 6) AS {out}"
            )
        else:
            cols.append(f"  CAST(NULL AS DOUBLE) AS {out}")
    return (
        "SELECT CAST(ts AS DATE) AS date,\n" + ",\n".join(cols)
        + ",\n  user_id AS city_id\nFROM events GROUP BY user_id, CAST(ts AS DATE)"
    )


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "aq_daily": q_aq_daily,
    "aq_daily_reset": q_aq_daily_reset,
    "rolling_mean_8": q_rolling_mean_8,
    "rolling_mean_8_gaps": q_rolling_mean_8_gaps,
    "daily_mean": q_daily_mean,
    "daily_max": q_daily_max,
    "outer_combine": q_outer_combine,
    "city_dedup": q_city_dedup,
    "city_topk": q_city_topk,
    "city_topk_sql": q_city_topk_sql,
    "city_head": q_city_head,
    "chunk_assign": q_chunk_assign,
    "request_batches": q_request_batches,
    "series_explode": q_series_explode,
    "positional_zip": q_positional_zip,
    "keyed_json_pivot": q_keyed_json_pivot,
    "period_daily": q_period_daily,
    "period_yearly": q_period_yearly,
    "period_lag": q_period_lag,
    "climate_join_discharge": q_climate_join_discharge,
    "climate_join_discharge_left": q_climate_join_discharge_left,
    "chunk_union": q_chunk_union,
    "sentinel_null": q_sentinel_null,
    "rename_coded": q_rename_coded,
    "quantize_2": q_quantize_2,
    "upsert_full": q_upsert_full,
    "upsert_narrow": q_upsert_narrow,
    "dq_unique": q_dq_unique,
    "dq_between": q_dq_between,
    "dq_pair": q_dq_pair,
    "dq_lower": q_dq_lower,
    "dq_suite": q_dq_suite,
    "not_null_length": q_not_null_length,
    "fk_orphans": q_fk_orphans,
    "batch_pick": q_batch_pick,
    "quantize_declared": q_quantize_declared,
    "climate_pipeline": q_climate_pipeline,
    "air_quality_pipeline": q_air_quality_pipeline,
    "land_surface_pipeline": q_land_surface_pipeline,
    **io_catalog.QUERIES,
}

ORACLE_SQL: dict[str, str] = {
    "aq_daily": _aq_daily_sql("city_id"),
    "aq_daily_reset": _aq_daily_sql("city_id, CAST(date AS DATE)"),
    "rolling_mean_8": ROLLING_SQL.format(c="value", expr="value", out="value_8h"),
    "rolling_mean_8_gaps": ROLLING_SQL.format(
        c="v", expr="CASE WHEN event_type <> 'error' THEN value END", out="v_8h"
    ),
    "daily_mean": DAILY_MEAN_SQL,
    "daily_max": DAILY_MAX_SQL,
    "outer_combine": OUTER_COMBINE_SQL,
    "city_dedup": CITY_DEDUP_SQL,
    "city_topk": CITY_TOPK_SQL,
    "city_topk_sql": CITY_TOPK_SQL_SQL,
    "city_head": CITY_HEAD_SQL,
    "chunk_assign": CHUNK_ASSIGN_SQL,
    "request_batches": REQUEST_BATCHES_SQL,
    "series_explode": SERIES_EXPLODE_SQL,
    "positional_zip": POSITIONAL_ZIP_SQL,
    "keyed_json_pivot": KEYED_JSON_PIVOT_SQL,
    "period_daily": _period_sql("1997-05-28", "1997-05-28"),
    "period_yearly": _period_sql("1997-01-01", "1998-01-01"),
    "period_lag": _period_sql("1997-05-27", "1997-05-27"),
    "climate_join_discharge": _join_discharge_sql("INNER"),
    "climate_join_discharge_left": _join_discharge_sql("LEFT"),
    "chunk_union": CHUNK_UNION_SQL,
    "sentinel_null": SENTINEL_NULL_SQL,
    "rename_coded": RENAME_CODED_SQL,
    "quantize_2": QUANTIZE_2_SQL,
    "upsert_full": UPSERT_FULL_SQL,
    "upsert_narrow": UPSERT_NARROW_SQL,
    "dq_unique": suite_sql("lineitem", DQ_UNIQUE, LINEITEM_COLUMNS),
    "dq_between": suite_sql("lineitem", DQ_BETWEEN, LINEITEM_COLUMNS),
    "dq_pair": suite_sql("lineitem", DQ_PAIR, LINEITEM_COLUMNS),
    "dq_lower": suite_sql("lineitem", DQ_LOWER, LINEITEM_COLUMNS),
    "dq_suite": suite_sql("lineitem", DQ_SUITE, LINEITEM_COLUMNS),
    "not_null_length": suite_sql("customer", DQ_STORE, CUSTOMER_COLS),
    "fk_orphans": FK_ORPHANS_SQL,
    "batch_pick": BATCH_PICK_SQL,
    "quantize_declared": QUANTIZE_DECLARED_SQL,
    "climate_pipeline": CLIMATE_PIPELINE_SQL,
    "air_quality_pipeline": _air_quality_pipeline_sql(),
    "land_surface_pipeline": _land_surface_pipeline_sql(),
    **io_catalog.ORACLE_SQL,
}
