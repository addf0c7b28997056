"""Quality rules and mixing against brute force on awkward rows."""

import hashlib
import math
import re
import struct
import unicodedata

import pytest
import xxhash
from pyspark.sql import functions as F

from airshed.llm import mixing, quality_rules

from .helpers import DOC_SCHEMA, awkward_docs, same, with_clashes, words


def repeat_words(ws, width=8):
    seen = {}
    for i in range(len(ws) - width + 1):
        seen.setdefault(tuple(ws[i : i + width]), []).append(i)
    covered = set()
    for at in seen.values():
        if len(at) > 1:
            covered.update(k for i in at for k in range(i, i + width))
    return len(covered)


def spark_xxhash(parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), h)
    return struct.unpack("<q", struct.pack("<Q", h))[0]


def shapes(text):
    out = ""
    for c in text or "":
        k = unicodedata.category(c)
        out += "a" if k in ("Ll", "Lo", "Lm") or k[0] == "M" else "A" if k in ("Lu", "Lt") else "9" if c in "0123456789" else c
    return words(re.sub(r"a+", "a", re.sub(r"A+", "A", re.sub(r"9+", "9", out))))


def buckets(text):
    s, n, b = shapes(text), quality_rules.N, quality_rules.BUCKETS
    grams = [s[i : i + n] for i in range(len(s) - n + 1)] or ([s] if s else [])
    return [spark_xxhash(g) % b for g in grams]


def brute_quality(rows, trusted):
    b = quality_rules.BUCKETS
    raw, good = [1] * b, [1] * b
    for i, text, *_ in rows:
        for g in buckets(text):
            raw[g] += 1
            good[g] += i in trusted
    ratio = [math.log(x / sum(good)) - math.log(y / sum(raw)) for x, y in zip(good, raw)]
    out = []
    for i, text, *_ in rows:
        ws, t = words(text), text or ""
        lines = [x for x in t.split("\n") if words(x)]
        n_rep = repeat_words(ws)
        failed = len(ws) < 20 or 100 * n_rep > 30 * len(ws)
        g = buckets(text)
        score = sum(ratio[x] for x in g) / len(g) if g else None
        out.append(
            (i, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), n_rep,
             failed, not failed and score >= quality_rules.THRESHOLD)
        )
    return out


def quality_rows(spark, rows, labels):
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    return [
        tuple(r)[:8]
        for r in quality_rules.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        .collect()
    ]


def test_quality_matches_brute_force(spark):
    rows = awkward_docs() + [(200, "a b c d e f g h " * 4 + "tail", None, None, 0), (201, "Über Äpfel 12 34.5 ##x " * 9, None, None, 0)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(30)] + [(None, 1, 0), (5, None, 0)]
    trusted = {i for i, q, _ in labels if q == 1 and i is not None}
    got = quality_rows(spark, rows, labels)
    same(got, brute_quality(rows, trusted))
    verdict = {r[0]: r[7] for r in got}
    assert not verdict[113] and not verdict[100] and not verdict[101]


@pytest.mark.parametrize("rows", [[], awkward_docs()])
def test_quality_without_labels(spark, rows):
    same(quality_rows(spark, rows, []), brute_quality(rows, set()))


def test_quality_learns_from_every_trusted_document(spark):
    """If all documents are trusted the two models are one, however many there are."""
    texts = ["plain prose here and there", "Some 12 Words 3 4", "### || 99 && <x>"]
    docs = spark.range(20_100).select(F.col("id").alias("doc_id"), F.get(F.array(*map(F.lit, texts)), (F.col("id") % 3).cast("int")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    judged = quality_rules.quality(docs, labels.union(labels))  # an id counts once
    assert judged.count() == 20_100
    assert [r[0] for r in judged.select("score").distinct().collect()] == [0.0]


def brute_mix(rows):
    sized = [(i, len(words(t)), s) for i, t, _, s, _ in rows]
    order = sorted({s for *_, s in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, n, x in sized if x == s) for s in order}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(size.values())
    while True:  # share, stop what is above its cap, share the rest again
        left = 1.5 * total - sum(2 * size[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: 2 * size[s] if s in full else left * weight[s] / w for s in order}
        over = {s for s in order if s not in full and target[s] >= 2 * size[s]}
        if not over:
            break
        full |= over
        if len(full) == len(order):
            target = {s: 2 * size[s] for s in order}
            break
    key = lambda r: (hashlib.md5(str(r[0]).encode() if r[0] is not None else b"").hexdigest(), r[0] or 0, r[1])
    out = []
    for s in order:
        before = 0
        for i, n, _ in sorted((r for r in sized if r[2] == s), key=key):
            room = math.floor(target[s]) - before
            taken = max(0, min(n, room)) + max(0, min(n, room - size[s]))
            out.append((i, n, size[s], round(target[s], 6), taken))
            before += n
    return out


@pytest.mark.parametrize("rows", [[], awkward_docs(), awkward_docs()[:1], [(1, None, None, None, None)]])
def test_mix_matches_brute_force(spark, rows):
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    same([(*r[:3], round(r[3], 6), r[4]) for r in got], brute_mix(rows))


def test_mix_meets_targets_and_budget(spark):
    rows = awkward_docs()
    mixed = mixing.mix(spark.createDataFrame(rows, DOC_SCHEMA)).cache()
    by_source = mixed.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) < 1 for r in by_source)
    plan = mixing.schedule(mixed).collect()
    finish = [r["virtual_finish"] for r in plan]
    assert finish == sorted(finish)
    assert sum(r["words"] for r in plan) == sum(r["sum(taken)"] for r in by_source)
