"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics of the library are defined in UTC; dynamic partition overwrite is
# what makes keyed upserts into date-partitioned tables safe.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    app: str = "airshed",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session. On a cluster, the submitter's session is used as is."""
    conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; a local folder is only chosen when the setting is
    absent (tests, a laptop). Never a machine-local folder on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^,\]]*\])?$", master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="airshed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path under the shared checkpoint folder (staging tables)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/airshed-{what}-{uuid.uuid4().hex}"


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps that come from epoch seconds are UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path in any store the cluster can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def list_folder(spark: SparkSession, path: str, before: float | None = None) -> list[str]:
    """Names in a folder, sorted; those last changed up to ``before`` (epoch seconds)."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if before is None or s.getModificationTime() / 1000 <= before)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a name that is not taken."""
    fs, source = _hadoop(spark, path)
    _, target = _hadoop(spark, to)
    if not fs.rename(source, target):
        raise OSError(f"can't move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file (and its folders)."""
    fs, p = _hadoop(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Rename the folder ``staged`` to ``path`` unless there is one already.

    False: another one was there first; ``staged`` is deleted. A file with a
    name of its own in the folder tells whose it is: where a file system moves
    or copies a folder *into* an existing one of that name, the mark is not at
    the top. ``staged``'s own name has to begin with ``_``, so that readers
    overlook such a stray until it is removed.
    """
    own = staged.rstrip("/").rpartition("/")[2]
    if not own.startswith("_"):
        raise ValueError(f"a staged folder's name begins with '_': {staged}")
    mark = f"_owner-{uuid.uuid4().hex}"
    write_text(spark, f"{staged}/{mark}", "")
    if not path_exists(spark, path):
        fs, source = _hadoop(spark, staged)
        _, target = _hadoop(spark, path)
        fs.rename(source, target)
        if path_exists(spark, f"{path}/{mark}"):
            return True
        remove(spark, f"{path}/{own}")
    remove(spark, staged)
    return False


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``. The version before is
    kept as ``path__old`` until the new one is in place."""
    fs, target = _hadoop(spark, path)
    _, source = _hadoop(spark, new)
    _, old = _hadoop(spark, path.rstrip("/") + "__old")
    if fs.exists(target):
        fs.delete(old, True)
        if not fs.rename(target, old):
            raise OSError(f"can't move {path} aside")
    if not fs.rename(source, target):
        raise OSError(f"can't move {new} to {path}")
    fs.delete(old, True)


def restore_old(spark: SparkSession, path: str) -> None:
    """Undo a ``swap_in`` that broke off after the old version was moved."""
    fs, target = _hadoop(spark, path)
    _, old = _hadoop(spark, path.rstrip("/") + "__old")
    if not fs.exists(target) and fs.exists(old):
        fs.rename(old, target)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a scratch table when the application ends (its lazy readers may
    run until then)."""
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a scratch table made by ``scratch_path`` (through the Hadoop
    FileSystem of that path, so it works for any shared store)."""
    if "/airshed-" not in path:
        raise ValueError(f"not a scratch path: {path}")
    fs, p = _hadoop(spark, path)
    return bool(fs.delete(p, True))
