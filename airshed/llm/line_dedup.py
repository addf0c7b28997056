"""Line dedup: keep a frequent line only in the largest document that holds it.

1. Each document gives one record per distinct long line: 128-bit hash of the
   line's key, document, positions of the line in it.
2. The records are range-partitioned by (hash, document) and sorted by hash,
   then document descending. Equal hashes are neighbours and the first of a
   run is the largest document; a task streams its part, holds fewer than
   MIN_DOCS documents' records and emits the others as they come. A frequent
   line spans many partitions, so a hot line never meets one task.
3. Only the first and the last run of a partition may go on elsewhere. They
   give a count each (at most two rows per partition, hence broadcast), which
   settles the records that a task could not decide alone.
4. The result is a compressed bitmap per document: which lines to drop. Texts
   move once, when the bitmaps are applied.

Defined cases: null or empty text is one empty line; a null document id counts
as one document below all ids; rows with the same id are one document, each
row has its own bitmap, and all lines of the kept document stay; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import SPACE_BYTES, column, materialize, release, small_batches, table, text_bytes
from airshed.session import shuffle_partitions

MIN_CHARS = 40
MIN_DOCS = 5

_RECORD = {"h1": pa.int64(), "h2": pa.int64(), "doc_id": pa.int64(), "row_key": pa.int64(), "at": pa.list_(pa.int32())}
_EVENT = {"what": pa.string(), **_RECORD, "n_docs": pa.int64()}
_RECORD_DDL = "h1 long, h2 long, doc_id long, row_key long, at array<int>"
_EVENT_DDL = f"what string, {_RECORD_DDL}, n_docs long"
_OUT_ROWS = 4096


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, fields.values(), strict=True)], names=list(fields))


def _long_lines(text: bytes, min_chars: int) -> dict[bytes, list[int]]:
    """Positions of every distinct key of at least min_chars code points."""
    lines: dict[bytes, list[int]] = {}
    for i, line in enumerate(text.lower().split(b"\n")):  # bytes.lower() changes A-Z only
        if len(line) >= min_chars:
            key = line.strip(SPACE_BYTES)
            if len(key) >= 4 * min_chars or len(key.decode()) >= min_chars:
                lines.setdefault(key, []).append(i)
    return lines


def _records(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, row_key, text in zip(column(b, "doc_id").to_pylist(), column(b, "row_key").to_pylist(), text_bytes(b), strict=True):
                for key, at in _long_lines(text, min_chars).items():
                    h = xxhash.xxh3_128_intdigest(key)
                    rows.append(((h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), doc, row_key, at))
            yield _batch(rows, _RECORD)

    return run


def _first_occurrences(min_docs: int):
    """Stream runs of equal hashes in a sorted partition. Events: 'drop', a
    record decided here; 'open', one that the counts must settle; 'run', number
    of documents and largest document of the first and the last run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[tuple] = []
        key = largest = last = None
        n, first, began = 0, True, False
        for b in batches:
            for rec in zip(*(column(b, c).to_pylist() for c in _RECORD), strict=True):
                if not began or rec[:2] != key:
                    if began and first:
                        out.append(("run", *key, largest, None, None, n))
                    first = not began
                    began, held, n, key, largest = True, [], 0, rec[:2], rec[2]
                if n == 0 or rec[2] != last:
                    n, last = n + 1, rec[2]
                if first:  # larger documents may stand in the partition before
                    out.append(("open", *rec, None))
                elif rec[2] != largest:
                    held.append(rec)
                    if n >= min_docs:
                        out.extend(("drop", *r, None) for r in held)
                        held = []
                if len(out) >= _OUT_ROWS:
                    yield _batch(out, _EVENT)
                    out = []
        if began:  # the last run may go on in the next partition
            out.extend(("open", *r, None) for r in held)
            out.append(("run", *key, largest, None, None, n))
        yield _batch(out, _EVENT)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = []
        for at in column(b, "at").to_pylist():
            bits = np.zeros(max(at) + 1, np.uint8)
            bits[at] = 1
            packed.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 6))
        cols = [column(b, "doc_id"), column(b, "row_key"), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row_key", "drops"])


def dropped_lines(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Flag per line from a bitmap of ``line_bitmaps`` (None: nothing dropped)."""
    flags = np.zeros(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n_lines]
        flags[: len(bits)] = bits
    return flags


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row_key"))


def line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row_key, drops: the compressed bitmap of every row that loses lines."""
    spark = docs.sparkSession
    small_batches(spark)
    records = materialize(_rows(docs, id_col, text_col).mapInArrow(_records(min_chars), _RECORD_DDL), "line-records")
    order = [F.col("h1"), F.col("h2"), F.desc_nulls_last("doc_id")]
    in_order = records.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    events = materialize(in_order.mapInArrow(_first_occurrences(min_docs), _EVENT_DDL), "line-events")
    small_batches(spark)
    release(records)
    settled = (
        events.where("what = 'run'")
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("_n"), F.max("doc_id").alias("_largest"))
        .where(F.col("_n") >= min_docs)
    )
    still_open = events.where("what = 'open'").join(F.broadcast(settled), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("_largest")))
    cols = ["doc_id", "row_key", "at"]
    drops = events.where("what = 'drop'").select(*cols).union(still_open.select(*cols))
    per_row = drops.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_list("at")).alias("at"))
    return per_row.mapInArrow(_pack, "doc_id long, row_key long, drops binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, bitmap in zip(text_bytes(b), column(b, "drops").to_pylist(), strict=True):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if bitmap is not None:
                lines = [x for x, gone in zip(lines, dropped_lines(bitmap, len(lines)), strict=True) if not gone]
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(b"\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [column(b, "doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept"],
        )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text without its dropped lines)."""
    rows = _rows(docs, id_col, text_col)
    marks = bitmaps.select(F.col("doc_id").alias("_d"), F.col("row_key").alias("_k"), "drops")
    joined = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row_key") == F.col("_k")), "left")
    return joined.select("doc_id", "text", "drops").mapInArrow(_apply, "doc_id long, n_lines long, n_dropped long, kept string")


def q_line_dedup(spark, sf_dir: str) -> DataFrame:
    """op8: per document, lines before and dropped, digest of what stays."""
    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, line_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i, l,
    translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT lines.*, (f.k IS NOT NULL AND lines.doc_id <> f.keeper) AS gone
  FROM lines LEFT JOIN frequent f ON lines.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
