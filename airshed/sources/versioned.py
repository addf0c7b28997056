"""Versioned Parquet tables: a write becomes visible whole, or not at all.

Layout of a table folder::

    _data/commit=<id>/date=2024-03-01/part-...   immutable, one folder per write
    _versions/v00000007/manifest.json            partition -> commit folder

A write puts its partitions into a new commit folder, which no version names
yet, and then publishes the manifest of the next version by one rename of a
folder. The highest version is the table; a reader resolves it once and goes on
reading the same immutable files whatever is written meanwhile. A job that dies
anywhere before the rename leaves the version before; its commit folder is
garbage until ``vacuum``. Two writers that start from one version both try to
publish the same number: the rename succeeds for one, the other one fails with
``ConcurrentWriteError`` (and may be run again on the new version).

The manifest has an entry per live partition, so what passes through the driver
grows with the number of days, not with the rows. The rename must be atomic, as
it is on HDFS and local file systems; a plain object store needs a committer in
front. A folder written as plain Parquet before is adopted as it lies: its
partitions are named by the first manifest and replaced as writes touch them.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.upsert import upsert
from airshed.session import drop_scratch, list_folder, path_exists, publish, read_text, remove, write_text
from airshed.sources.readers import try_read_parquet
from airshed.sources.writers import stage_source, target_schema_of, touched_target

#: Commit of partitions that a plain Parquet folder had before it was adopted.
PLAIN = ""


class ConcurrentWriteError(RuntimeError):
    """Another writer published the next version first."""


@dataclass(frozen=True)
class Version:
    """What a manifest says. ``parts``: partition folder ("" if the table has
    no partitions) -> commit folder."""

    number: int
    schema: T.StructType
    partition_col: str | None
    parts: dict[str, str] = field(default_factory=dict)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    names = list_folder(spark, f"{path}/_versions") if path_exists(spark, f"{path}/_versions") else []
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"v(\d+)", n)))


def _manifest(path: str, number: int) -> str:
    return f"{path}/_versions/v{number:08d}"


def load_version(spark: SparkSession, path: str, number: int) -> Version:
    said = json.loads(read_text(spark, f"{_manifest(path, number)}/manifest.json"))
    return Version(number, T.StructType.fromJson(said["schema"]), said["partition_col"], said["parts"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The table's latest version; a plain Parquet folder counts as version 0."""
    path = path.rstrip("/")
    if numbers := versions(spark, path):
        return load_version(spark, path, numbers[-1])
    plain = try_read_parquet(spark, path)
    if plain is None:
        return None
    parts = [n for n in list_folder(spark, path) if "=" in n]
    column = parts[0].split("=")[0] if parts else None
    return Version(0, plain.schema, column, dict.fromkeys(parts or [""], PLAIN))


def read_version(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """The rows of one version: only the folders its manifest names are listed."""
    path = path.rstrip("/")
    names = [n for n in version.schema.fieldNames() if n != version.partition_col]
    names += [version.partition_col] if version.partition_col else []  # last, as in plain Parquet
    out = None
    for plain in (True, False):
        chosen = [(c, p) for p, c in version.parts.items() if (c == PLAIN) is plain]
        if not chosen:
            continue
        base = path if plain else f"{path}/_data"
        folders = [f"{base}/{c}/{p}".rstrip("/") if c else f"{base}/{p}".rstrip("/") for c, p in chosen]
        schema = version.schema if plain else T.StructType([*version.schema.fields, T.StructField("commit", T.StringType())])
        rows = spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*names)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], version.schema).select(*names) if out is None else out


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as its latest version, or as version ``number``, has it."""
    path = path.rstrip("/")
    version = current(spark, path) if number is None else load_version(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_version(spark, path, version)


def write_version(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    base: Version | None,
    partition_col: str | None = "date",
    cluster_cols: list[str] | None = None,
    replace_all: bool = False,
    drop_parts: list[str] | None = None,
) -> Version:
    """Write ``df`` as the next version after ``base``: the partitions it has
    take the place of theirs (``replace_all``: of all), ``drop_parts`` go."""
    path = path.rstrip("/")
    commit = f"commit={uuid.uuid4().hex}"
    folder = f"{path}/_data/{commit}"
    order = [c for c in [partition_col, *(cluster_cols or [])] if c]
    rows = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order) if order else df
    writer = rows.write
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.parquet(folder)
    written = [n for n in list_folder(spark, folder) if "=" in n] if partition_col else [""]
    kept = {} if base is None or replace_all else {p: c for p, c in base.parts.items() if p not in (drop_parts or ())}
    parts = {**kept, **dict.fromkeys(written, commit)}
    version = Version(base.number + 1 if base else 1, df.schema, partition_col, parts)
    _publish_version(spark, path, version)
    return version


def _publish_version(spark: SparkSession, path: str, version: Version) -> None:
    """Put the version in place by one rename, unless its number is taken."""
    staged = f"{path}/_versions/_new-{uuid.uuid4().hex}"
    said = {"schema": version.schema.jsonValue(), "partition_col": version.partition_col, "parts": version.parts}
    write_text(spark, f"{staged}/manifest.json", json.dumps(said))
    if not publish(spark, staged, _manifest(path, version.number)):
        raise ConcurrentWriteError(f"version {version.number} of {path} was published by another writer")


def _touched_parts(version: Version, source: DataFrame) -> Version:
    """The version cut to the days from the source's first to its last, so that
    no other folder is listed; all of it unless it is partitioned by a date."""
    column = version.partition_col
    if not column or not isinstance(version.schema[column].dataType, T.DateType):
        return version
    lo, hi = source.agg(F.min(column), F.max(column)).first()
    inside = {p: c for p, c in version.parts.items() if lo and f"{column}={lo.isoformat()}" <= p <= f"{column}={hi.isoformat()}"}
    return replace(version, parts=inside)


def merge_versioned(
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
    target_schema: T.StructType | None = None,
    retries: int = 0,
) -> DataFrame:
    """Upsert ``source`` into the versioned table at ``path``; returns the new
    version's rows. Keys, checks and merge semantics are those of ``merge_into``;
    the touched partitions are written once, into the new commit folder. A
    writer that comes second is run again on the new version up to ``retries``
    times, then fails."""
    path = path.rstrip("/")
    now = now if now is not None else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    for left in range(retries, -1, -1):
        base = current(spark, path)
        if base and base.partition_col != partition_col:
            raise ValueError(f"{path} is partitioned by {base.partition_col}, not {partition_col}")
        schema = base.schema if base else target_schema or target_schema_of(source, dedup_by, created_col)
        stage, rows = stage_source(spark, source, schema, keys, dedup_by)
        try:
            target = read_version(spark, path, _touched_parts(base, rows)) if base else spark.createDataFrame([], schema)
            held = touched_target(target, rows, keys, partition_col if base else None)
            merged = upsert(held, rows, keys, update_cols, now, created_col)
            order = [cluster_col] if partition_col and cluster_col else list(keys)
            version = write_version(spark, path, merged, base, partition_col, order)
            return read_version(spark, path, version)
        except ConcurrentWriteError:
            if not left:
                raise
        finally:
            drop_scratch(spark, stage)
    raise AssertionError("unreachable")


def replace_table(spark: SparkSession, path: str, df: DataFrame, cluster_cols: list[str], partition_col: str | None = None) -> DataFrame:
    """All rows of the table are ``df``'s from one version to the next."""
    base = current(spark, path)
    version = write_version(spark, path, df, base, partition_col, cluster_cols, replace_all=True)
    return read_version(spark, path, version)


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than_s: float = 86_400) -> list[str]:
    """Delete versions but the last ``keep``, and the commit folders that no
    version names, unless they are younger than ``older_than_s`` (a writer may
    be about to publish them). Returns the folders that went."""
    path = path.rstrip("/")
    numbers = versions(spark, path)
    old, kept = numbers[: max(len(numbers) - keep, 0)], numbers[max(len(numbers) - keep, 0) :]
    live = {c for n in kept for c in load_version(spark, path, n).parts.values()}
    before = time.time() - older_than_s
    gone = [_manifest(path, n) for n in old]
    for folder, live_names in ((f"{path}/_data", live), (f"{path}/_versions", {f"v{n:08d}" for n in numbers})):
        if path_exists(spark, folder):
            found = list_folder(spark, folder, before=before)
            gone += [f"{folder}/{n}" for n in found if n not in live_names]
    for folder in gone:
        remove(spark, folder)
    return gone
