"""Sinks: CSV, chunk files, date-partitioned tables and the keyed merge."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.upsert import assert_unique_keys, last_per_key, upsert
from airshed.session import drop_scratch, restore_old, scratch_path, shuffle_partitions, swap_in
from airshed.sources.readers import CSV_OPTIONS, try_read_parquet


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row (replaces the target)."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_chunks(chunked: DataFrame, path: str, chunk_col: str = "chunk_id") -> None:
    """One folder per chunk (``chunk_id=N``), rows in ``pos`` order; replaces
    all chunks of an earlier write."""
    (
        chunked.repartition(F.col(chunk_col))
        .sortWithinPartitions(chunk_col, "pos")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(chunk_col)
        .parquet(path)
    )


def write_chunk_files(chunked: DataFrame, path: str, size: int, chunk_col: str = "chunk_id") -> DataFrame:
    """One file per chunk of exactly ``size`` rows (the last one may have less),
    in one folder, replacing an earlier write; returns the index table.

    Range partitioning keeps a chunk in one task and gives each task whole
    chunks, so the writer's limit of ``size`` rows a file cuts just between
    them; file names sort by position. The index (``_index``: file, chunk,
    rows) tells which file to open, so a reader lists no folder per chunk.
    """
    spark = chunked.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    beside = f"{parent}/_building-{name}-{uuid.uuid4().hex}"
    rows = chunked.repartitionByRange(shuffle_partitions(spark), F.col(chunk_col)).sortWithinPartitions(chunk_col, "pos")
    rows.write.option("maxRecordsPerFile", size).parquet(beside)
    held = spark.read.schema(chunked.schema).parquet(beside).groupBy(F.col("_metadata.file_name").alias("file"))
    index = held.agg(F.min(chunk_col).alias(chunk_col), F.max(chunk_col).alias("_last"), F.count(F.lit(1)).alias("rows"))
    index = index.select("file", F.when(F.col(chunk_col) == F.col("_last"), F.col(chunk_col)).otherwise(F.raise_error(F.lit("a file holds two chunks"))).cast("int").alias(chunk_col), "rows")
    index.repartitionByRange(1, chunk_col).sortWithinPartitions(chunk_col).write.parquet(f"{beside}/_index")
    swap_in(spark, beside, path)
    return spark.read.schema(index.schema).parquet(f"{path.rstrip('/')}/_index")


def write_raw_chunks(raw: DataFrame, path: str, run_col: str = "run_date", chunk_col: str = "chunk_id") -> None:
    """Raw responses keyed by run date and chunk; a rerun replaces exactly the
    (run date, chunk) folders it produces (dynamic partition overwrite)."""
    (
        raw.repartition(F.col(run_col), F.col(chunk_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_col, chunk_col)
        .parquet(path)
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str = "date",
    cluster_col: str | None = "city_id",
    mode: str = "overwrite",
    replace_all: bool = False,
) -> None:
    """Day-partitioned, ``city_id``-clustered Parquet; rewrites only the days
    present in ``df`` (dynamic partition overwrite), or with ``replace_all``
    the whole table.

    Range partitioning on (day, city) spreads a large day over several tasks
    (one file each, sorted by city), so row-group min/max skipping works.
    """
    order = [partition_col] + ([cluster_col] if cluster_col else [])
    (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def target_schema_of(source: DataFrame, dedup_by: str | None, created_col: str | None) -> T.StructType:
    """Schema of a new table: the source's, and the creation time."""
    fields = [f for f in source.schema.fields if f.name != dedup_by]
    if created_col and created_col not in source.columns:
        fields.append(T.StructField(created_col, T.TimestampType(), True))
    return T.StructType(fields)


def stage_source(spark: SparkSession, source: DataFrame, schema: T.StructType, keys: list[str], dedup_by: str | None) -> tuple[str, DataFrame]:
    """(path, rows) of a staging copy of the source, its keys cast to the
    target's types, repeated ones resolved by ``dedup_by``: computed once."""
    source = source.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})
    if dedup_by:
        source = last_per_key(source, keys, dedup_by)
        if dedup_by not in schema.fieldNames():
            source = source.drop(dedup_by)
    stage = scratch_path(spark, "merge-source")
    source.write.parquet(stage)
    return stage, spark.read.schema(source.schema).parquet(stage)


def touched_target(target: DataFrame, source: DataFrame, keys: list[str], partition_col: str | None) -> DataFrame:
    """The target's rows in partitions the source has (a range filter prunes
    them, a semi join selects them; all rows if there are no partitions). The
    keys of both have to be there and unique."""
    assert_unique_keys(source, keys)
    if partition_col:
        lo, hi = source.agg(F.min(partition_col), F.max(partition_col)).first()
        days = source.select(partition_col).distinct()
        held = target.filter(F.col(partition_col).between(F.lit(lo), F.lit(hi)))
        target = held.join(days, partition_col, "left_semi").select(*target.columns)
    assert_unique_keys(target, keys, "target")
    return target


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    now: dt.datetime | Column | None = None,
    partition_col: str | None = "date",
    cluster_col: str | None = "city_id",
    created_col: str | None = "created_at",
    dedup_by: str | None = None,
    target_schema=None,
) -> DataFrame:
    """Upsert ``source`` into the Parquet table at ``path``; returns the table.

    The keys are cast to the target's types before anything else looks at
    them. NULL keys are an error, and so are repeated ones (after the cast), in
    the source and in the part of the target that is read; ``dedup_by`` names a
    column whose greatest value wins among repeated source keys. Only the
    target partitions that the source has are read (a range filter prunes them,
    a semi join selects them) and rewritten (dynamic overwrite). Source and
    merged rows go through staging copies in the shared checkpoint folder: the
    source is computed once, and a table cannot be overwritten while it is
    being read. An unpartitioned table is written beside and swapped in.
    """
    if now is None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if not partition_col:
        restore_old(spark, path)
    target = try_read_parquet(spark, path)
    is_new = target is None
    if is_new:
        target = spark.createDataFrame([], target_schema or target_schema_of(source, dedup_by, created_col))
    source_stage, source = stage_source(spark, source, target.schema, keys, dedup_by)
    stage = scratch_path(spark, "merge")
    try:
        target = touched_target(target, source, keys, None if is_new else partition_col)
        merged = upsert(target, source, keys, update_cols, now, created_col)
        merged.write.mode("overwrite").parquet(stage)
    finally:
        drop_scratch(spark, source_stage)
    try:
        staged = spark.read.schema(merged.schema).parquet(stage)
        if partition_col:
            write_partitioned(staged, path, partition_col, cluster_col)
        else:
            order = [F.col(k) for k in keys]
            beside = path.rstrip("/") + "__new"
            staged.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(beside)
            swap_in(spark, beside, path)
    except Exception as e:
        # Kept: if the commit broke off half-way, this is the one whole copy of the merged rows.
        e.add_note(f"merged rows kept at {stage}")
        raise
    drop_scratch(spark, stage)  # the target now holds the merged rows
    # explicit schema: a new table fed by an empty source has no file to infer one from
    return spark.read.schema(merged.schema).parquet(path)
