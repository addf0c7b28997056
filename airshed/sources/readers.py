"""Scans: city CSV, raw response tables, date-partitioned facts, batches."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.timecols import file_stem
from airshed.operators.cities import scan_position
from airshed.schemas import WORLD_CITIES_CSV_SCHEMA
from airshed.session import list_folder, move, path_exists, publish, remove


#: One CSV dialect for reading and writing: doubled quotes, line feeds inside
#: quotes, blanks kept. Quoted line feeds mean that a file is not split; the
#: city list is small.
CSV_OPTIONS = {
    "header": True, "escape": '"', "multiLine": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV in the library's dialect; a malformed line fails the job."""
    r = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST")
    return (r.schema(schema) if schema is not None else r).csv(path)


def read_cities_csv(spark: SparkSession, path: str, schema: T.StructType = WORLD_CITIES_CSV_SCHEMA) -> DataFrame:
    """City list CSV with a header row; the file order is kept in ``_pos``.

    Columns are matched by header name, not position (no inference pass: read
    as text, then cast to the declared types; a bad number fails the job).
    A column missing from the header is an error; extra columns are ignored.
    """
    raw = scan_position(read_csv(spark, path))
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"CSV header lacks columns {missing}")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], "_pos")


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """One or many Parquet paths (files or folders), optionally with a fixed schema."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(*paths)


def try_read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path, or a folder
    without data files. Anything else that can't be read is an error."""
    if not path_exists(spark, path):
        return None
    r = spark.read
    try:
        df = (r.schema(schema) if schema is not None else r).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    return df if schema is None or df.inputFiles() else None


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether a snapshot folder is whole: its job ended, or a rename put it there."""
    return path_exists(spark, path) and any(n == "_SUCCESS" or n.startswith("_owner-") for n in list_folder(spark, path))


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None) -> DataFrame:
    """Reuse the Parquet snapshot at ``path`` when present, else build it,
    write it and read it back (so every later use sees the same rows).

    A snapshot is written beside and put in place by one rename, unless another
    builder's is there by then: that one is used, and this one deleted. What a
    writer that died left half-written at ``path`` itself is moved aside and
    deleted, never read.
    """
    path = path.rstrip("/")
    parent, _, name = path.rpartition("/")
    if not is_published(spark, path):
        beside = f"{parent}/_building-{name}-{uuid.uuid4().hex}"
        df = build()
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(beside)
        _clear_unpublished(spark, path)
        publish(spark, beside, path)
    return spark.read.parquet(path)


def _clear_unpublished(spark: SparkSession, path: str) -> None:
    """Move a folder aside that is no whole snapshot, then delete it. If it
    became one in between, it goes back."""
    if not path_exists(spark, path) or is_published(spark, path):
        return
    parent, _, name = path.rpartition("/")
    aside = f"{parent}/_broken-{name}-{uuid.uuid4().hex}"
    move(spark, path, aside)
    if not (is_published(spark, aside) and publish(spark, aside, path)):
        remove(spark, aside)


def read_chunk_files(spark: SparkSession, path: str, chunks: list[int] | None = None, chunk_col: str = "chunk_id") -> DataFrame:
    """Chunks as ``write_chunk_files`` wrote them; of named chunks only their
    files are opened (the index says which)."""
    path = path.rstrip("/")
    if chunks is None:
        return spark.read.parquet(path)
    index = spark.read.parquet(f"{path}/_index").filter(F.col(chunk_col).isin(list(chunks)))
    files = [f"{path}/{r['file']}" for r in index.select("file").collect()]  # as many as chunks are named
    whole = spark.read.parquet(path)
    return spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)


def read_stem_chunks(spark: SparkSession, paths: list[str], schema: T.StructType | str) -> DataFrame:
    """Raw files named by their chunk (``7.parquet``): the chunk id is the stem
    of the file that a row is read from; a name that is no number is an error."""
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.select("*", file_stem().cast("int").alias("chunk_id"))


def read_day(spark: SparkSession, table_path: str, day: dt.date, col: str = "date") -> DataFrame:
    """One day of a date-partitioned table (partition pruning)."""
    return spark.read.parquet(table_path).filter(F.col(col) == F.lit(day))


def read_dated_file(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """Batch pick by name ``YYYY-MM-DD.parquet`` in a folder (a single file or
    a Spark output folder): only the matching path is listed and read."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{day.isoformat()}.parquet")
