"""Queries that go through sources and sinks: each writes a driver table to a
fresh folder under the shared checkpoint folder and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.clean import null_nan, to_spec
from airshed.operators.cities import assign_chunks, clean_cities
from airshed.operators.quality import WARNING, between, gate, pair_ge, run_suite
from airshed.schemas import DAILY_AIR_QUALITY
from airshed.session import delete_at_exit, ensure_utc, scratch_path
from airshed.sources.readers import read_chunk_files, read_cities_csv, read_dated_file, read_or_build, read_parquet
from airshed.sources.versioned import merge_versioned
from airshed.sources.writers import write_chunk_files, write_csv, write_partitioned, write_raw_chunks

T0, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _folder(spark: SparkSession, what: str) -> str:
    path = scratch_path(spark, what)
    spark.createDataFrame([], "x int").write.parquet(path + "/_made")  # so that it can be marked
    delete_at_exit(spark, path)
    return path


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_csv_cities(spark, sf_dir):
    """Customers as a city CSV whose names hold quotes, commas and blanks, read
    by header name, deduplicated on coordinates (first in file order) and cast."""
    path = _folder(spark, "csv") + "/cities"
    key = F.col("c_custkey")
    name = F.concat(F.lit('  "'), F.col("c_name"), F.lit('", '), F.col("c_mktsegment"), F.lit(" "))
    rows = _table(spark, sf_dir, "customer").select(
        name.alias("city"), F.col("c_name").alias("city_ascii"), (key % 97).cast("double").alias("lat"),
        F.col("c_nationkey").cast("double").alias("lng"), F.col("c_mktsegment").alias("country"),
        F.lit(None).cast("string").alias("iso2"), F.lit(None).cast("string").alias("iso3"),
        F.lit(None).cast("string").alias("admin_name"), F.lit(None).cast("string").alias("capital"),
        F.floor("c_acctbal").cast("double").alias("population"), key.cast("long").alias("id"),
    )
    write_csv(rows.repartitionByRange("id").sortWithinPartitions("id"), path)
    clean = clean_cities(read_cities_csv(spark, path))
    return clean.select("city_id", "city", "city_ascii", "lat", "lng", "country", "population")


CSV_CITIES_SQL = """
SELECT city_id, city, city_ascii, lat, lng, country, population FROM (
  SELECT CAST(c_custkey AS BIGINT) AS city_id, '  "' || c_name || '", ' || c_mktsegment || ' ' AS city, c_name AS city_ascii,
         CAST(c_custkey % 97 AS DOUBLE) AS lat, CAST(c_nationkey AS DOUBLE) AS lng, c_mktsegment AS country,
         CAST(floor(c_acctbal) AS BIGINT) AS population,
         row_number() OVER (PARTITION BY c_custkey % 97, c_nationkey ORDER BY c_custkey) AS r
  FROM customer) WHERE r = 1
"""


def q_multi_file_scan(spark, sf_dir):
    """One scan over several Parquet folders (orders by status)."""
    root = _folder(spark, "files")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    parts = {"f": F.col("o_orderstatus") == "F", "rest": ~F.col("o_orderstatus").eqNullSafe("F")}
    for name, which in parts.items():
        orders.filter(which).write.parquet(f"{root}/{name}")
    return _doubles(read_parquet(spark, *[f"{root}/{name}" for name in parts], schema=orders.schema))


MULTI_FILE_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders"


def q_snapshot_reuse(spark, sf_dir):
    """The second caller reads the first one's snapshot, whatever it would build."""
    path = _folder(spark, "snapshot") + "/suppliers"
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    read_or_build(spark, path, lambda: supplier)
    return _doubles(read_or_build(spark, path, lambda: supplier.limit(0)))


SNAPSHOT_SQL = "SELECT s_suppkey, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier"


def q_chunk_files(spark, sf_dir):
    """Files of a chunk each written twice; only the second layout is left."""
    path = _folder(spark, "chunks") + "/cities"
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    write_chunk_files(assign_chunks(cust, ["c_custkey"], size=20), path, 20)
    write_chunk_files(assign_chunks(cust, ["c_custkey"], size=50), path, 50)
    return read_chunk_files(spark, path).select("c_custkey", "c_nationkey", "chunk_id", "pos")


CHUNK_FILES_SQL = """
SELECT c_custkey, c_nationkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS INTEGER) AS chunk_id,
       CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 50 AS INTEGER) AS pos
FROM customer
"""


def q_raw_chunks(spark, sf_dir):
    """Raw responses by run date and chunk; a rerun replaces its own folders."""
    path = _folder(spark, "raw") + "/feed"
    emb = _table(spark, sf_dir, "embeddings").select("vec_id", "label", F.element_at("embedding", 1).cast("double").alias("first"))
    raw = emb.withColumns({"run_date": F.date_add(F.lit(T0.date()), F.col("label").cast("int") % 2), "chunk_id": (F.col("label") % 5).cast("int")})
    write_raw_chunks(raw, path)
    write_raw_chunks(raw.filter("chunk_id = 3").withColumn("first", F.col("first") + 1), path)
    return _doubles(read_parquet(spark, path).select("vec_id", "label", "first", "run_date", "chunk_id"))


RAW_CHUNKS_SQL = """
SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE) + CASE WHEN label % 5 = 3 THEN 1 ELSE 0 END, 6) AS first,
       CAST(DATE '2024-01-01' + CAST(label % 2 AS INTEGER) AS DATE) AS run_date, CAST(label % 5 AS INTEGER) AS chunk_id
FROM embeddings
"""


def q_transformed_rerun(spark, sf_dir):
    """A partitioned, clustered table; rewriting some partitions keeps the rest."""
    path = _folder(spark, "transformed") + "/orders"
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc(F.to_date("o_orderdate"), "year").alias("date"), F.col("o_custkey").alias("city_id")
    )
    write_partitioned(orders, path)
    late = F.col("date") >= F.lit(dt.date(1996, 1, 1))
    write_partitioned(orders.filter(late).withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    return _doubles(read_parquet(spark, path).select("o_orderkey", "o_totalprice", "city_id", "date"))


TRANSFORMED_SQL = """
SELECT o_orderkey, round(o_totalprice + CASE WHEN o_orderdate >= DATE '1996-01-01' THEN 1 ELSE 0 END, 6) AS o_totalprice,
       o_custkey AS city_id, CAST(date_trunc('year', o_orderdate) AS DATE) AS date
FROM orders
"""


def q_staging_projection(spark, sf_dir):
    """Staging rows: keys and declared decimals of the measures present."""
    ev = _table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("date"), F.col("user_id").alias("city_id"), F.col("value").alias("pm10_mean"),
        (F.col("value") / 8).alias("ozone_8h_max"), F.lit("x").alias("note"),
    )
    staged = to_spec(ev, DAILY_AIR_QUALITY)
    return staged.select("date", "city_id", *[F.col(c).cast("double").alias(c) for c in ("pm10_mean", "ozone_8h_max")])


STAGING_SQL = """
SELECT CAST(ts AS DATE) AS date, CAST(user_id AS BIGINT) AS city_id,
       CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(8, 2)) AS DOUBLE) AS pm10_mean,
       CAST(CAST(CAST(value / 8 AS VARCHAR) AS DECIMAL(10, 2)) AS DOUBLE) AS ozone_8h_max
FROM events
"""


def q_nan_to_null(spark, sf_dir):
    """NaN (here: the value of every error event) becomes NULL."""
    nan = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return _doubles(null_nan(_table(spark, sf_dir, "events").select("event_id", nan.alias("v"))))


NAN_SQL = "SELECT event_id, round(CASE WHEN event_type <> 'error' THEN value END, 6) AS v FROM events"


def q_dated_batch(spark, sf_dir):
    """Batch pick by file name among the files of several days."""
    root = _folder(spark, "daily")
    ev = _table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    days = [dt.date(2024, 1, d) for d in (14, 15)]
    for day in days:
        ev.filter(F.col("day") == F.lit(day)).write.parquet(f"{root}/{day.isoformat()}.parquet")
    return _doubles(read_dated_file(spark, root, days[1]))


DATED_SQL = """
SELECT event_id, user_id, round(value, 6) AS value, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'
"""


def q_gate_report(spark, sf_dir):
    """The warnings that a gate lets pass: line items over 40 pieces, and those
    with a discount not under the tax."""
    suite = [
        between("l_quantity", 0, 40, severity=WARNING), between("l_discount", 0, 1),
        pair_ge("l_tax", "l_discount", or_equal=False, severity=WARNING),
    ]
    failed = gate(run_suite(_table(spark, sf_dir, "lineitem"), suite))
    rows = [(f["idx"], f["column"], f["severity"], f["evaluated"], f["unexpected"]) for f in failed]
    return spark.createDataFrame(rows, "idx int, `column` string, severity string, evaluated long, unexpected long")


GATE_SQL = """
SELECT * FROM (
  SELECT CAST(0 AS INTEGER) AS idx, 'l_quantity' AS "column", 'warning' AS severity, count(l_quantity) AS evaluated,
         count(*) FILTER (WHERE l_quantity < 0 OR l_quantity > 40) AS unexpected FROM lineitem
  UNION ALL
  SELECT CAST(2 AS INTEGER), 'l_tax,l_discount', 'warning', count(*) FILTER (WHERE l_tax IS NOT NULL OR l_discount IS NOT NULL),
         count(*) FILTER (WHERE (l_tax IS NOT NULL OR l_discount IS NOT NULL) AND NOT coalesce(l_tax > l_discount, FALSE)) FROM lineitem)
WHERE unexpected > 0
"""


def q_merge_table(spark, sf_dir):
    """Two merges into one versioned table, read back: matched orders take the
    second price, others stay or come in."""
    path = _folder(spark, "merged") + "/orders"
    orders = _table(spark, sf_dir, "orders").select(
        F.trunc(F.to_date("o_orderdate"), "year").alias("date"), F.col("o_orderkey").alias("city_id"), "o_totalprice", "o_orderstatus"
    )
    first = orders.filter(F.col("o_orderstatus").isin("F", "O"))
    second = orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    merge_versioned(spark, path, first, ["date", "city_id"], now=T0)
    merged = merge_versioned(spark, path, second, ["date", "city_id"], now=NOW)
    late = (F.col("created_at") == F.lit(NOW)).alias("is_new")
    return _doubles(merged.select("date", "city_id", "o_totalprice", "o_orderstatus", late))


MERGE_SQL = """
SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS date, o_orderkey AS city_id,
       round(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END, 6) AS o_totalprice,
       o_orderstatus, o_orderstatus = 'P' AS is_new
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
"""

QUERIES = {
    "csv_cities": q_csv_cities,
    "multi_file_scan": q_multi_file_scan,
    "snapshot_reuse": q_snapshot_reuse,
    "chunk_files": q_chunk_files,
    "raw_chunks": q_raw_chunks,
    "transformed_rerun": q_transformed_rerun,
    "staging_projection": q_staging_projection,
    "nan_to_null": q_nan_to_null,
    "dated_batch": q_dated_batch,
    "gate_report": q_gate_report,
    "merge_table": q_merge_table,
}

ORACLE_SQL = {
    "csv_cities": CSV_CITIES_SQL,
    "multi_file_scan": MULTI_FILE_SQL,
    "snapshot_reuse": SNAPSHOT_SQL,
    "chunk_files": CHUNK_FILES_SQL,
    "raw_chunks": RAW_CHUNKS_SQL,
    "transformed_rerun": TRANSFORMED_SQL,
    "staging_projection": STAGING_SQL,
    "nan_to_null": NAN_SQL,
    "dated_batch": DATED_SQL,
    "gate_report": GATE_SQL,
    "merge_table": MERGE_SQL,
}
