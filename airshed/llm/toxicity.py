"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic
function of its hashed features; the document's is their noisy-or,
1 - prod(1 - p). Only document labels are needed. Features whose document
counts differ between the classes by more than MIN_Z standard errors start
from their log odds (all others stay 0); then the log loss of the noisy-or is
minimised over sentences by proximal Adagrad steps under an L1 penalty. The
same sentence scores then locate the offending sentences.

Features of a word (lower-cased A-Z, run of letters, digits and non-ASCII
bytes): the word and its first 4 to 7 bytes, hashed. Labels, language, source
and id are never features.

The model is fitted in one task on a bounded sample: all rows outside the held
out fold if they are few, else about MAX_TOXIC and MAX_CLEAN documents by hash
of the id, and never more rows than that, however often an id is repeated. Every whole text of the table is scored where it lies; nothing is
shuffled but the sample.

Defined cases: null or empty text has no sentence and gets the probability of
an empty bag, 0; null labels teach nothing; without labels (or with one class
only) the model is its prior and no sentence offends; ids may be null or
repeated; an empty table gives an empty result; only the named columns are
read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import NOT_ALNUM, Split, WordHasher, chunked, column, crc_mod, small_batches, table, text_bytes

FOLDS = 5
MAX_TOXIC, MAX_CLEAN = 1500, 3000
BITS = 18
PREFIXES = (4, 5, 6, 7)
MIN_Z, START_SCALE, START_BIAS = 3.0, 0.3, -7.0
STEPS, RATE, L1, START_SQUARES = 300, 0.1, 0.1, 25.0
SENTENCE_END = b".!?\n"


class Model(NamedTuple):
    bias: float
    weights: np.ndarray  # by feature bucket


def sentence_starts(words: Split) -> np.ndarray:
    """Index of the first word of every sentence; texts begin sentences."""
    if not len(words.start):
        return np.zeros(0, np.int64)
    ender = np.flatnonzero(np.isin(words.buf, np.frombuffer(SENTENCE_END, np.uint8)))
    text = np.searchsorted(words.at, words.start, side="right")
    number = np.searchsorted(ender, words.start) + text
    return np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1))


def features(words: Split) -> np.ndarray:
    """Feature buckets, one column per kind of feature and row per word."""
    kinds = [words.hashes(), *(words.hashes(n) + np.uint64(n) for n in PREFIXES)]
    return np.stack([(h >> np.uint64(64 - BITS)).astype(np.int32) for h in kinds], axis=1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def _log1pexp(x):
    return np.logaddexp(0, x)


def _selected(pairs: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Significant feature buckets and their smoothed log odds, from distinct
    (document, feature) pairs."""
    doc, feature = pairs >> BITS, pairs & (1 << BITS) - 1
    toxic = np.bincount(feature[labels[doc] == 1], minlength=1 << BITS).astype(float)
    clean = np.bincount(feature[labels[doc] == 0], minlength=1 << BITS).astype(float)
    share, n_toxic, n_clean = labels.mean(), labels.sum(), (1 - labels).sum()
    expected = (toxic + clean) * share
    z = (toxic - expected) / np.sqrt(expected * (1 - share) + 0.5)
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    chosen = np.flatnonzero(np.abs(z) > MIN_Z)
    return chosen, odds[chosen]


def _fit(texts: list[bytes], labels: np.ndarray) -> Model:
    weights = np.zeros(1 << BITS, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Model(-12.0, weights)
    hasher = WordHasher(NOT_ALNUM)
    pairs, owners, owned, docs = [], [], [], []
    n_sent = 0
    for first, group in chunked(texts):
        words = hasher.split(group)
        f, s = features(words), sentence_starts(words)
        doc = np.searchsorted(words.at, words.start, side="right") - 1 + first
        pairs.append(np.unique(doc[:, None].astype(np.int64) << BITS | f))
        sentence = np.repeat(np.arange(len(s)), np.diff(np.append(s, len(f))))
        owners.append(np.repeat(sentence + n_sent, f.shape[1]).astype(np.int32))
        owned.append(f.ravel())
        docs.append(doc[s])
        n_sent += len(s)
    chosen, odds = _selected(np.concatenate(pairs), labels)
    rank = np.full(1 << BITS, -1, np.int32)
    rank[chosen] = np.arange(len(chosen))
    used = [rank[f] >= 0 for f in owned]
    f = rank[np.concatenate([f[u] for f, u in zip(owned, used)])]
    owner = np.concatenate([o[u] for o, u in zip(owners, used)])
    doc = np.concatenate(docs)
    y, n_docs = labels[doc], len(labels)
    w, bias = START_SCALE * odds, START_BIAS
    squares, bias_squares = np.full(len(w), START_SQUARES), START_SQUARES
    for _ in range(STEPS):
        logit = bias + np.bincount(owner, weights=w[f], minlength=n_sent)
        p = _sigmoid(logit)
        none = np.exp(np.minimum(-np.bincount(doc, weights=_log1pexp(logit), minlength=n_docs), -1e-9))
        slope = np.where(y == 1, -p * (none / (1 - none))[doc], p)
        grad = np.bincount(f, weights=slope[owner], minlength=len(w))
        squares += grad * grad
        step = RATE / np.sqrt(squares)
        w = w - step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        bias_squares += slope.sum() ** 2
        bias -= RATE * slope.sum() / np.sqrt(bias_squares)
    weights[chosen] = w
    return Model(float(bias), weights)


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((i is None, i, t, y) for b in batches for i, t, y in zip(
        column(b, "doc_id").to_pylist(), text_bytes(b), column(b, "_toxic").to_pylist(), strict=True
    ))
    model = _fit([r[2] for r in rows], np.array([r[3] for r in rows], np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(model))], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Train on a bounded sample of the labelled rows outside the held out fold."""
    small_batches(docs.sparkSession)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != 0))
    ids = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("long").alias("_toxic"))
    pick = lambda y, n: ids.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    sample = pick(1, max_toxic).union(pick(0, max_clean))  # bounded, so it may be broadcast
    rows = docs.join(F.broadcast(sample), docs["doc_id"] == sample["_id"]).select(docs["doc_id"], docs["text"], "_toxic")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(max_toxic + max_clean)  # an id may have many rows
    fitted = rows.repartition(1).mapInArrow(_fit_task, "model binary").first()  # no row: nothing to learn from
    return Model(*pickle.loads(fitted["model"])) if fitted else _fit([], np.zeros(0, np.int64))


def _scorer(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        for b in batches:
            score, found = [], []
            for _, texts in chunked(text_bytes(b)):
                words = hasher.split(texts)
                first = sentence_starts(words)
                if not len(first):
                    score += [0.0] * len(texts)
                    found += [[] for _ in texts]
                    continue
                logit = model.bias + np.add.reduceat(model.weights[features(words)].sum(axis=1, dtype=np.float64), first)
                doc = np.searchsorted(words.at, words.start[first], side="right") - 1
                none = np.bincount(doc, weights=_log1pexp(logit), minlength=len(texts))
                score += np.clip(-np.expm1(-none), 0, 1).tolist()
                spans: list[list] = [[] for _ in texts]
                last = np.append(first[1:], len(words.start)) - 1
                for s in np.flatnonzero(logit >= np.log(threshold / (1 - threshold))):
                    d = doc[s]
                    text = texts[d]
                    lo, hi = (int(x - words.at[d]) for x in (words.start[first[s]], words.end[last[s]]))
                    at = len(text[:lo].decode())
                    spans[d].append({"start": at, "end": at + len(text[lo:hi].decode()), "score": float(_sigmoid(logit[s]))})
                found += spans
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            cols = [column(b, "doc_id"), pa.array(score, pa.float64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "sentences"])

    return run


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, sentences: those at or over the threshold (code points)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(_scorer(model, threshold), "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>")


def q_toxicity(spark, sf_dir: str) -> DataFrame:
    """op7: toxicity of every document, and how many sentences offend."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("sentences").alias("n_offending"),
    )
