"""Line dedup against brute force on awkward rows, over many partitions."""

import hashlib

import pytest

from airshed.llm import line_dedup
from airshed.llm.common import small_batches

from .helpers import DOC_SCHEMA, SPACES, awkward_docs, same, with_clashes


def low(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute(rows, min_docs):
    holders = {}
    split = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    for i, lines in split:
        for x in lines:
            holders.setdefault(low(x.strip(SPACES)), set()).add(i)
    rank = lambda i: -1 if i is None else i
    out = []
    for i, lines in split:
        keep = []
        for x in lines:
            k = low(x.strip(SPACES))
            gone = len(k) >= 40 and len(holders[k]) >= min_docs and i != max(holders[k], key=rank)
            keep += [] if gone else [x]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("min_docs", [2, 5])
def test_matches_brute_force(spark, parts, min_docs):
    shared = ["common " * 9, "Ö" * 40, "ö" * 39, "  tail spaces are not part of a key, nor is case   "]
    rows = awkward_docs() + [(300 + i, "\n".join([shared[i % 4], shared[0], f"own {i}"] * 2), None, None, 0) for i in range(40)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(5))
        kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=min_docs)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        small_batches(spark)
    got = [(r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in kept]
    same(got, brute(rows, min_docs))


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).collect() == []


def test_bitmap_round_trip():
    assert line_dedup.dropped_lines(None, 3).tolist() == [False] * 3
