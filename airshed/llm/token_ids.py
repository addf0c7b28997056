"""Token ids as compressed binary files, and back.

Writing: the documents are range-sorted by id; a task tokenises its part (see
``piece_ids``), adds END_ID to each document and cuts the stream of ids into segments of whole
documents (about SEGMENT_IDS ids), each coded by ``range_coder`` in
independently reset, checksummed blocks. A segment is a row (shard, its first
id within the shard, documents and their lengths, coded bytes) of a Parquet
table, so files are committed by Spark and a lost task writes its part again.

Reading: every segment decodes alone; a document's place in the whole stream
is its shard's offset (one row per shard, hence broadcast) plus its place in
the shard.

Defined cases: null text is empty and has the end id alone; rows are ordered by
id, null ids first, then by text; repeated rows are documents of their own; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm import range_coder
from airshed.llm.common import column, small_batches, table, text_bytes
from airshed.llm.piece_ids import PieceIds
from airshed.session import scratch_path, shuffle_partitions

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
SEGMENT_IDS = 1 << 23

_SEGMENT = {
    "shard": pa.int32(), "first_in_shard": pa.int64(), "n_ids": pa.int64(), "doc_ids": pa.list_(pa.int64()),
    "lengths": pa.list_(pa.int64()), "data": pa.binary(),
}
_SEGMENT_DDL = "shard int, first_in_shard long, n_ids long, doc_ids array<long>, lengths array<long>, data binary"


def load_tokenizer(name: str):
    """A tokenizer by its path, or by its file name among the public ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(name)
    if tokenizer.get_vocab_size() > 1 << 16:
        raise ValueError("ids must fit in 16 bits")
    return tokenizer


def _kept_encoder(name: str) -> PieceIds:
    """One per Python worker, kept over its tasks: loading a tokenizer takes long."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    if name not in vars(kept):
        setattr(kept, name, PieceIds(load_tokenizer(name)))
    return getattr(kept, name)


def _write_segments(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept_encoder(tokenizer)
        shard, first, held = 0, 0, 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            row = (shard, first, held, docs, [len(x) for x in ids], range_coder.encode(np.concatenate(ids)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _SEGMENT.values(), strict=True)], names=list(_SEGMENT))

        for b in batches:
            if not b.num_rows:
                continue
            shard = column(b, "shard")[0].as_py()
            for doc, x in zip(column(b, "doc_id").to_pylist(), encoder(text_bytes(b)), strict=True):
                docs.append(doc)
                ids.append(np.append(x, np.uint16(END_ID)))
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield segment()
                    first, held, docs, ids = first + held, 0, [], []
        if docs:
            yield segment()

    return run


def write_ids(docs: DataFrame, dest: str, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise and write all documents below ``dest``, in order of their ids."""
    spark = docs.sparkSession
    small_batches(spark, 64)  # where a text is encoded in one go, that takes some hundred bytes a token
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    begin = F.substring("text", 1, 64)  # parts the rows of a hot or null id over many tasks, in the order of texts
    in_order = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", begin).sortWithinPartitions("doc_id", "text")
    numbered = in_order.withColumn("shard", F.spark_partition_id())
    segments = numbered.mapInArrow(_write_segments(tokenizer), _SEGMENT_DDL)
    segments.write.option("compression", "uncompressed").parquet(dest)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for shard, first, n, docs, lengths, data in zip(*(column(b, c).to_pylist() for c in _SEGMENT), strict=True):
            ids = range_coder.decode(data)
            if len(ids) != n:
                raise ValueError("a segment's length is wrong")
            cut = np.concatenate(([0], np.cumsum(lengths)))
            wide = ids.astype("<u4")
            crcs = [zlib.crc32(wide[s:e]) for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
            cols = [
                pa.array([shard] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(cut[:-1] + first, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["shard", "doc_id", "_at", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, source: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    segments = spark.read.schema(_SEGMENT_DDL).parquet(source)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rows = segments.mapInArrow(_read_segments, "shard int, doc_id long, _at long, n_tokens long, ids_crc32 long")
    joined = rows.join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", (F.col("_off") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def q_token_ids(spark, sf_dir: str) -> DataFrame:
    """op10: write all documents as ids, read the files back."""
    dest = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), dest)
    return read_ids(spark, dest)
