"""Quality by compression: two zstandard dictionaries, one built from good and
one from bad labelled text.

A text is cut into pieces of ``PIECE`` bytes (a piece so short gains from a
dictionary, a whole text would soon be its own); each piece is compressed with
either dictionary. The text's gain is the bytes that the good dictionary saves
over the bad one, by byte of text. A logistic curve, fitted on labelled rows
that no dictionary has seen, turns the gain into the probability of label 1.

What is fitted is bounded and documented: of at most ``SAMPLE`` ids of each label
the ``SAMPLE`` distinct pieces with the least hashes, and the gains of
``CALIBRATION`` rows of as many ids. Only these ids are broadcast; no text is
shuffled to find them. Pieces are cut to the sample in every task before they
meet, so neither a long text, nor a repeated id, nor a large group of copies
fills the sample or a task. Every whole text of the
table is scored where it lies; nothing else is shuffled.

Defined cases: a null or empty text, and any text if a label has no pieces,
gets the share of label 1 among the labelled rows (0.5 without any); null
labels and ids teach nothing; rows that repeat a labelled id all count; ids may
be null or repeated; an empty table gives an empty result; only the named
columns are read. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import column, crc_mod, table, text_bytes

FOLDS, THRESHOLD = 5, 0.3
PIECE, LEVEL = 1024, 3
DICTIONARY, SAMPLE = 1 << 16, 6000
#: One labelled row in so many calibrates; at most ``CALIBRATION`` of them.
HOLD_BACK, CALIBRATION = 4, 20_000
STEPS, RIDGE = 50, 1e-3
#: The logistic curve works on gains in hundredths of the text.
UNIT = 100.0


class Model(NamedTuple):
    dictionaries: tuple[bytes, bytes] | None  # of labels 0 and 1
    slope: float
    offset: float
    prior: float


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def _compressors(dictionaries: tuple[bytes, bytes]) -> list[Callable[[bytes], bytes]]:
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    out = []
    for data in dictionaries:
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **plain).compress)
    return out


def gains(texts: list[bytes], dictionaries: tuple[bytes, bytes]) -> list[float]:
    """(size with the bad dictionary - size with the good one) / bytes."""
    bad, good = _compressors(dictionaries)
    return [sum(len(bad(p)) - len(good(p)) for p in pieces(t)) / max(len(t), 1) for t in texts]


def _least_pieces(sample: int) -> Callable:
    """label, text -> the distinct pieces of least hash in this task, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, bytes]] = {0: {}, 1: {}}
        for b in batches:
            for label, text in zip(column(b, "label").to_pylist(), text_bytes(b)):
                mine = held[label]
                for p in pieces(text):
                    mine[xxhash.xxh3_64_intdigest(p) >> 1] = p
                    if len(mine) > 2 * sample:
                        held[label] = mine = {k: mine[k] for k in sorted(mine)[:sample]}
        for label, mine in held.items():
            keys = sorted(mine)[:sample]
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array([mine[k] for k in keys], pa.binary())],
                names=["label", "key", "piece"],
            )

    return run


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"".join(samples)[-DICTIONARY:]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted({r for b in batches for r in zip(*(column(b, n).to_pylist() for n in ("label", "key", "piece")))})
    both = [[p for y, _, p in rows if y == label] for label in (0, 1)]
    trained = [_dictionary(x) if x else b"" for x in both]
    yield pa.RecordBatch.from_arrays([pa.array([d], pa.binary()) for d in trained], names=["bad", "good"])


def _gains(dictionaries: tuple[bytes, bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(b)
            size = pa.array([len(t) for t in texts], pa.int64())
            keys = pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([column(b, "label"), keys, size, pa.array(gains(texts, dictionaries), pa.float64())], names=["label", "key", "bytes", "gain"])

    return run


def calibrate(gain: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps with a small ridge."""
    x = np.stack([gain * UNIT, np.ones(len(gain))], axis=1)
    w = np.zeros(2)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - label) + RIDGE * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, calibration: int = CALIBRATION) -> Model:
    """Train on the labelled rows outside the held out fold."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != 0))
    ids = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("label"))
    share = ids.agg(F.avg("label")).first()[0]
    prior = 0.5 if share is None else float(share)
    back = F.pmod(F.xxhash64("_id"), F.lit(HOLD_BACK)) == 0
    order = [F.xxhash64("_id", F.lit("sample")), F.col("_id")]  # two longs an id: sample + calibration of them may be broadcast
    chosen = [ids.where(~back & (F.col("label") == y)).orderBy(*order).limit(sample) for y in (0, 1)]
    own = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("text"))
    rows = lambda some: own.join(F.broadcast(some), F.col("_doc") == F.col("_id")).select("label", "text")

    found = rows(chosen[0].union(chosen[1])).mapInArrow(_least_pieces(sample), "label int, key long, piece binary")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("key"))
    least = found.dropDuplicates(["label", "key"]).withColumn("rank", rank).where(F.col("rank") <= sample)  # bounded: it meets in one task
    trained = least.select("label", "key", "piece").repartition(1).mapInArrow(_train, "bad binary, good binary").first()
    if trained is None or not trained["bad"] or not trained["good"]:
        return Model(None, 0.0, 0.0, prior)
    both = (bytes(trained["bad"]), bytes(trained["good"]))

    seen = rows(ids.where(back).orderBy(*order).limit(calibration)).mapInArrow(_gains(both), "label int, key long, bytes long, gain double")
    known = seen.where("bytes > 0").orderBy("key", "label").limit(calibration).select("label", "gain").collect()  # bounded: two numbers a row
    label = np.array([r["label"] for r in known], float)
    if len(set(label.tolist())) < 2:
        return Model(None, 0.0, 0.0, prior)
    slope, offset = calibrate(np.array([r["gain"] for r in known], float), label)
    return Model(both, slope, offset, prior)


def probability(gain: float, model: Model) -> float:
    return float(1 / (1 + np.exp(-np.clip(model.slope * gain * UNIT + model.offset, -500, 500))))


def _scorer(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(b)
            gain: list[float | None] = [None] * len(texts)
            if model.dictionaries:
                gain = [g if t else None for t, g in zip(texts, gains(texts, model.dictionaries))]
            score = [model.prior if g is None else probability(g, model) for g in gain]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(gain, pa.float64()), pa.array(score, pa.float64())], names=["doc_id", "gain", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, gain (null: no text or no dictionaries), score (0 to 1)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, gain double, score double")


def q_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: probability of good quality for every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "gain",
    )
