"""Language ID: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams (1 to 3 code points) of the lower-cased text, all
other than letters being one separator; a document's vector is
(1 + log count) * idf, scaled to length 1. Document frequencies are counted
over every document that may be learnt from. The weights are trained with
follow-the-regularised-leader (FTRL-proximal, L1 and L2) on a bounded sample
of about MAX_TRAIN documents spread evenly over the languages, in one task;
a fifth of the sample is set aside to fit the temperature that calibrates the
probabilities. Whole texts are predicted where they lie.

Only text and language of documents outside the held out fold are learnt from;
language, source and id are never features.

Defined cases: a null text or one without a letter is ``und`` with score 0, and
so is every text if there is nothing to learn from; a null language teaches
nothing; ids may be null (then not sampled) or repeated; an empty table gives
an empty result; only the named columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import CHUNK_BYTES, column, crc_mod, small_batches, table

FOLDS, HELD_OUT = 3, 1
MAX_TRAIN = 3000
BITS = 14
MAX_N = 3
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 0.3, 0.3
UNDETERMINED = "und"
_KEYS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


class Model(NamedTuple):
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket by language
    bias: np.ndarray
    temperature: float


class Grams:
    """Hashed n-gram counts of texts."""

    def __init__(self):
        self.letter = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)

    def _letters(self, cp: np.ndarray) -> np.ndarray:
        known = self.letter[np.minimum(cp, 0xFFFF)]
        high = np.flatnonzero(cp > 0xFFFF)
        known[high] = [chr(c).isalpha() for c in cp[high].tolist()]
        return known

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """(buckets, counts) per text, None for texts without a letter."""
        low = [t.lower() for t in texts]
        cp = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self._letters(cp)
        cp = np.where(letter, cp, np.uint32(32))
        grams = []
        h = np.zeros(len(cp), np.uint32)
        for k in range(min(MAX_N, len(cp))):
            h = h[: len(cp) - k] + cp[k:] * np.uint32(_KEYS[k])
            x = h * np.uint32(_KEYS[3])
            x ^= x >> np.uint32(15)
            x *= np.uint32(_KEYS[0])
            grams.append((x >> np.uint32(32 - BITS)).astype(np.int64))
        n_letters = np.concatenate(([0], np.cumsum(letter)))
        at = 0
        for t in low:
            end = at + len(t)
            if n_letters[end] == n_letters[at]:
                yield None
            else:
                count = np.bincount(np.concatenate([g[at : max(at, end - k)] for k, g in enumerate(grams)]), minlength=1 << BITS)
                buckets = np.flatnonzero(count)
                yield buckets, count[buckets]
            at = end + 1


def _groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Whole texts in groups of bounded length."""
    group, held = [], 0
    for t in texts:
        if group and held + len(t or "") > CHUNK_BYTES:
            yield group
            group, held = [], 0
        group.append(t or "")
        held += len(t or "")
    if group:
        yield group


def _vector(gram: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = (1 + np.log(gram[1])) * idf[gram[0]]
    return gram[0], v / np.sqrt(v @ v)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each bucket; bucket -1 is the number of documents."""
    grams, df, n = Grams(), np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        for group in _groups(column(b, "text").to_pylist()):
            for g in grams(group):
                n += 1
                if g is not None:
                    df[g[0]] += 1
    have = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(have, -1), pa.int64()), pa.array(np.append(df[have], n), pa.int64())], names=["bucket", "n"]
    )


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its log."""

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    lo, hi, g = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with an elastic net, one coordinate set per language."""
    z = np.zeros(((1 << BITS) + 1, n_langs))
    n = np.zeros_like(z)

    def weights(zi, ni):
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    order = np.random.default_rng(9)
    for _ in range(EPOCHS):
        for i in order.permutation(len(y)):
            at = np.append(vectors[i][0], 1 << BITS)  # the last one is the bias
            v = np.append(vectors[i][1], 1.0)
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = _softmax(v @ w)
            p[y[i]] -= 1
            g = v[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - sigma * w
            n[at] = ni + g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def _train(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((t, x) for b in batches for t, x in zip(column(b, "text").to_pylist(), column(b, "lang").to_pylist(), strict=True))
        langs = sorted({x for _, x in rows})
        grams = Grams()
        found = [g for group in _groups([t for t, _ in rows]) for g in grams(group)]
        kept = [i for i, g in enumerate(found) if g is not None]
        vectors = [_vector(found[i], idf) for i in kept]
        y = np.array([langs.index(rows[i][1]) for i in kept], np.int64)
        order = np.random.default_rng(3).permutation(len(y))
        aside, learn = order[: len(y) // 5], order[len(y) // 5 :]
        weights, bias = _ftrl([vectors[i] for i in learn], y[learn], len(langs)) if len(y) else (np.zeros((1 << BITS, 0)), np.zeros(0))
        temperature = 1.0
        if len(aside):
            logits = np.stack([vectors[i][1] @ weights[vectors[i][0]] + bias for i in aside])
            temperature = _temperature(logits, y[aside])
        model = (langs if len(y) else [], idf, weights.astype(np.float32), bias, temperature)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return run


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    small_batches(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts = usable.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, n_docs = np.zeros(1 << BITS), 0
    for bucket, n in counts.collect():  # one row per bucket
        if bucket < 0:
            n_docs = n
        else:
            df[bucket] = n
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    # even over languages: each row's chance is its language's share over its size
    ids = usable.where(F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct()
    sizes = ids.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    each = max_train / max(1, sizes.count())
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / (1 << 30)
    drawn = ids.join(sizes, F.col("lang") == F.col("_lang")).where(draw < each / F.col("_n"))
    sample = drawn.orderBy(draw, "doc_id").limit(max_train).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    rows = usable.join(F.broadcast(sample), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    rows = rows.where(F.col("text").isNotNull()).select("doc_id", "text", "lang")
    rows = rows.orderBy(F.xxhash64("doc_id", "lang"), F.xxhash64("text")).limit(max_train).select("text", "lang")  # an id may have many rows
    trained = rows.repartition(1).mapInArrow(_train(idf), "model binary").first()  # no row: nothing to learn from
    return Model(*pickle.loads(trained["model"])) if trained else Model([], idf, np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)


def _predictor(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for b in batches:
            lang, score = [], []
            for group in _groups(column(b, "text").to_pylist()):
                for g in grams(group):
                    if g is None or not model.langs:
                        lang.append(UNDETERMINED)
                        score.append(0.0)
                        continue
                    at, v = _vector(g, model.idf)
                    p = _softmax((v @ model.weights[at] + model.bias) / model.temperature)
                    best = int(p.argmax())
                    lang.append(model.langs[best])
                    score.append(float(p[best]))
            cols = [column(b, "doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_predictor(model), "doc_id long, lang_pred string, score double")


def q_language_id(spark, sf_dir: str) -> DataFrame:
    """op9: predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, fit(docs))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
