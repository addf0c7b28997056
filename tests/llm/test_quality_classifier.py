"""Compression classifier: held-out accuracy, and its scores recomputed piece by piece."""

import math
import random
import zlib

import pytest
import zstandard

from airshed.llm import quality_classifier as qc

from .helpers import DOC_SCHEMA, awkward_docs, prose, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed=4, n=500):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(rng, rng.randint(30, 200))
        rows.append((i, text if good else "!! ".join(text.upper().split()), "en", "s0", 1))
        labels.append((i, int(good), 0))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % qc.FOLDS == 0


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = {r["doc_id"]: r["score"] for r in qc.score(docs, qc.fit(docs, spark.createDataFrame(labels, LABELS))).collect()}
    kept = [(got[i] >= qc.THRESHOLD) == bool(y) for i, y, _ in labels if held(i)]
    assert len(kept) > 60 and sum(kept) / len(kept) > 0.97


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    rows, labels = corpus(n=200)
    turned = [(i, 1 - y if held(i) else y, t) for i, y, t in labels]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    assert qc.fit(docs, spark.createDataFrame(labels, LABELS)) == qc.fit(docs, spark.createDataFrame(turned, LABELS))


def test_scores_recomputed_on_awkward_rows(spark):
    rows, labels = corpus(n=240)
    model = qc.fit(spark.createDataFrame(rows, DOC_SCHEMA), spark.createDataFrame(labels, LABELS))
    odd = awkward_docs()
    got = qc.score(with_clashes(spark.createDataFrame(odd, DOC_SCHEMA)), model).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd)
    want = {}
    for i, text, *_ in odd:
        data, saved = (text or "").encode(), 0
        for at in range(0, len(data), 1024):
            size = []
            for d in model.dictionaries:
                c = zstandard.ZstdCompressor(
                    level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False
                )
                size.append(len(c.compress(data[at : at + 1024])))
            saved += size[0] - size[1]
        z = model.slope * 100 * saved / max(len(data), 1) + model.offset
        want.setdefault(i, set()).add(round(1 / (1 + math.exp(-z)) if data else model.prior, 9))
    assert all(round(r["score"], 9) in want[r["doc_id"]] and 0 <= r["score"] <= 1 for r in got)


def test_copies_do_not_fill_the_sample(spark):
    """Half of the good rows are one text; the sample holds its pieces once."""
    rows, labels = corpus(n=300)
    text = prose(random.Random(1), 2000)
    rows += [(1000 + i, text, "en", "s0", 1) for i in range(300)]
    labels += [(1000 + i, 1, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = qc.fit(docs, spark.createDataFrame(labels, LABELS), sample=100)
    got = {r["doc_id"]: r["score"] for r in qc.score(docs, model).collect()}
    kept = [(got[i] >= qc.THRESHOLD) == bool(y) for i, y, _ in labels if held(i)]
    assert sum(kept) / len(kept) > 0.95


@pytest.mark.parametrize("rows", [[], awkward_docs()])
@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, None, 0), (None, 0, 1)], [(i, 1, 0) for i in range(30)]])
def test_without_both_labels_the_prior_stands(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = qc.fit(docs, spark.createDataFrame(labels, LABELS))
    assert model.dictionaries is None and model.prior == (1.0 if labels else 0.5)
    assert [r["score"] for r in qc.score(docs, model).collect()] == [model.prior] * len(rows)
