"""Helpers shared by the operators of this subpackage.

Scratch tables live in the folder the session names in ``spark.checkpoint.dir``
(see ``airshed.session``), so any executor can be lost and its part recomputed.
The text helpers run inside tasks on Arrow batches and hold one bounded chunk
of text at a time, plus at most one whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.session import delete_at_exit, drop_scratch, scratch_path, shuffle_partitions

#: The white space that separates words in every contract.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy pass works on.
CHUNK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write to a scratch table and read it back: cuts lineage, computes once."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    delete_at_exit(df.sparkSession, path)  # what is not released before
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and nothing reads any more."""
    drop_scratch(df.sparkSession, df._scratch)


def running_total(df: DataFrame, order: list[Column | str], value: str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over all rows before this one in ``order``.

    Range-partitioned and exact for any layout: sums inside a partition plus
    one offset per partition (that table has a row per partition, so it is
    broadcast). Ties in ``order`` must be equal in ``value`` too, or unique.
    """
    n = shuffle_partitions(df.sparkSession)
    laid = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    laid = materialize(laid, "running-total")
    before = Window.unboundedPreceding
    zero = F.lit(0).cast("long")
    totals = laid.groupBy("_part").agg(F.sum(value).alias("_n"))
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(before, -1)), zero).alias("_off"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(before, -1)), zero)
    rows = laid.withColumn("_in", inside).join(F.broadcast(offsets), "_part")
    return rows.withColumn(out, F.col("_off") + F.col("_in")).drop("_part", "_off", "_in")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows: texts may be long, tasks have little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def words_col(text: Column) -> Column:
    """Words of a text column (null: none), JVM side."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RE), "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def fmix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash (wraps around)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Split:
    """The words of some texts: bounds in one buffer, hashes, words by text."""

    def __init__(self, buf, start, end, run, inverse, at):
        self.buf, self.start, self.end, self._run, self._inverse = buf, start, end, run, inverse
        self.at = at  # where each text begins in the buffer
        self.cut = np.searchsorted(start, at)

    def hashes(self, length: int | None = None) -> np.ndarray:
        """64-bit hash of every word, or of its first ``length`` bytes."""
        end = self.end if length is None else np.minimum(self.start + length, self.end)
        return fmix64((self._run[end] - self._run[self.start]) * self._inverse[self.start])


class WordHasher:
    """64-bit hashes of all words of many texts in a few numpy passes.

    A word's hash is the polynomial sum of random values of its bytes, taken
    from one running sum over the chunk: (S[end] - S[start]) * B**-start.
    ``separators`` are the bytes between words; A-Z count as a-z.
    """

    _BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, separators: bytes = SPACE_BYTES):
        rng = np.random.default_rng(20240517)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.values[65:91] = self.values[97:123]
        self.gap = np.zeros(256, bool)
        self.gap[list(separators)] = True
        self.joint = bytes(separators[:1])
        self._grow(CHUNK_BYTES)

    def _grow(self, n: int) -> None:
        inverse = pow(self._BASE, -1, 1 << 64)
        self.pow = np.ones(n + 1, np.uint64)
        self.inv = np.ones(n + 1, np.uint64)
        np.cumprod(np.full(n, self._BASE, np.uint64), out=self.pow[1:])
        np.cumprod(np.full(n, inverse, np.uint64), out=self.inv[1:])

    def split(self, texts: list[bytes]) -> Split:
        buf = np.frombuffer(self.joint.join(texts) + self.joint, np.uint8)
        n = len(buf)
        if n >= len(self.pow):
            self._grow(2 * n)
        gap = self.gap[buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        run = np.empty(n + 1, np.uint64)
        run[0] = 0
        np.cumsum(self.values[buf] * self.pow[:n], out=run[1:])
        size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        return Split(buf, start[: len(end)], end, run, self.inv, np.concatenate(([0], np.cumsum(size))))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order; ``cut[i]:cut[i+1]`` are those of text i."""
        words = self.split(texts)
        return words.hashes(), words.cut


#: Everything in ASCII that is not a letter or a digit separates these words.
NOT_ALNUM = bytes(c for c in range(128) if not chr(c).isalnum())


def chunked(texts: Iterable[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts) groups of about ``size`` bytes, whole texts only."""
    group: list[bytes] = []
    first = held = 0
    for i, t in enumerate(texts):
        if group and held + len(t) > size:
            yield first, group
            group, first, held = [], i, 0
        group.append(t)
        held += len(t)
    if group:
        yield first, group


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a text column; null is empty."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
