"""The fit of the latent space reads each document's text once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from airshed.llm import decontaminate
from airshed.llm.common import NOT_ALNUM, WordHasher

TEXTS = ["the cat sat on the mat", "", None, "Ein Wort, zwei Worte; the END", "the " * 40, "über\x00 the mat"]


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def test_each_document_is_hashed_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{t or ''} word{i}") for i, t in enumerate(TEXTS)] + [(None, None)], "doc_id long, text string")
    items = spark.createDataFrame([("what does the cat do on the mat. it sat",)], "text string")
    want = decontaminate.latent_space(docs, items)
    read, words = spark.sparkContext.accumulator(0), decontaminate._words

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield from words(iter([b]))

    monkeypatch.setattr(decontaminate, "_words", counted)
    got = decontaminate.latent_space(docs, items)
    assert read.value == len(TEXTS) + 1 + decontaminate.ITERATIONS
    # singular vectors beyond the texts' rank are arbitrary: compare what they make of passages
    rows = np.array([[*range(k, k + decontaminate.WINDOW)] for k in range(0, 600, 50)])
    old, new = (decontaminate._total(x.astype(np.float64), rows) for x in (want, got))
    assert np.allclose(old @ old.T, new @ new.T, rtol=1e-2, atol=1e-3)


def test_frequencies_and_product_of_stored_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 64)  # several chunks
    stored = list(decontaminate._words(iter([batch(TEXTS), batch([]), batch(TEXTS[:1])])))
    hasher = WordHasher(NOT_ALNUM)
    buckets = [(hasher([(t or "").encode()])[0] >> decontaminate._SHIFT).tolist() for t in [*TEXTS, TEXTS[0]]]
    assert [np.frombuffer(w, "<u2").tolist() for b in stored for w in b.column(0).to_pylist()] == buckets
    want = {-1: len(buckets)}
    for words in buckets:
        for w in set(words):
            want[w] = want.get(w, 0) + 1
    got = next(iter(decontaminate._frequencies(iter(stored))))
    assert dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True)) == want

    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 1 << 19)
    idf, basis = np.linspace(0.5, 2, 1 << decontaminate.BITS), np.random.default_rng(1).standard_normal((1 << decontaminate.BITS, 3))
    size = decontaminate.WINDOW
    parts = {tuple(sorted(set(w[k : k + size]))) for w in buckets for k in range(0, len(w), size)}
    total = np.zeros_like(basis)
    for p in parts:  # rows of unit length of the TF-IDF matrix, each once
        row = np.zeros(len(idf))
        row[list(p)] = idf[list(p)]
        row /= np.sqrt((row**2).sum())
        total += np.outer(row, row @ basis)
    one = pa.Table.from_batches(stored).combine_chunks().to_batches()
    got = next(iter(decontaminate._product(idf, basis)(iter(one))))
    got = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, 3) for x in got.column(1).to_pylist()])
    assert np.allclose(got, total, rtol=1e-4, atol=1e-5)
