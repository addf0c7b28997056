"""MinHash near-dedup with an LSH forest.

A document's set are its distinct word shingles; documents are linked if their
sets have a Jaccard similarity of at least ``percent``, confirmed on full sets.
op3 has 3 words and 85 %; ``near_duplicates`` takes other values too.

1. One pass over the texts gives each document's set size, a 128-bit
   fingerprint of the set, and a signature of trees x DEPTH minhashes. Equal
   fingerprints are copies: only the smallest id of a class goes on.
2. The forest: each tree has its own DEPTH minhashes of a document, in order.
   All (tree, signature) rows are range-sorted, which no hot prefix can keep
   in one task. Rows that share at least MIN_DEPTH values are a region.
3. First the neighbours: in the sorted order the next row has the longest
   common prefix, so crowded regions are resolved at their own, greater depth.
   Neighbours of FIRST_TREES trees are confirmed and joined to components.
4. Then what is left at the least depth: in every region of any tree that
   still holds more than one component, the rows of different components are
   compared, likeliest first, until they are one component or no pair is left
   (in blocks of about BLOCK rows where a region is large; no row or partner
   is left out). A region that the neighbours settled costs nothing here. Only
   links leave a block, at most one per component, never the pairs tried.
   Size ratio and a 2-bit sketch of the signature (5 standard deviations of
   margin) sort out pairs before sets are compared.
5. Components of all confirmed links give the class of every document.

A linked pair shares MIN_DEPTH minhashes in some tree with probability at
least 1 - MISSED = 0.99999: 12 trees at 85 % (1 - (1 - 0.85**3)**12), 16 at 80 %.

Defined cases: null or blank text has an empty set and is linked with nothing;
with fewer words than a shingle the whole sequence is the one shingle; rows with the
same id are one node (linked with each other); a null id belongs to its copies'
component, is linked to nothing else and kept unless it has copies with an id;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import WordHasher, chunked, column, fmix64, materialize, release, small_batches, table, text_bytes
from airshed.llm.components import components
from airshed.session import shuffle_partitions

SHINGLE = 3
PERCENT = 85
DEPTH, MIN_DEPTH = 8, 3
MISSED = 1.1e-5
FIRST_TREES = 6
BLOCK = 1024

_PREFIX = 1 + 4 * MIN_DEPTH  # bytes of a region's key: tree, then values


class Rule(NamedTuple):
    """Words of a shingle, least similarity, and what follows from them."""

    width: int = SHINGLE
    percent: int = PERCENT

    @property
    def trees(self) -> int:
        """Trees that miss a linked pair with probability MISSED at most (a
        multiple of 4: sketches are whole 8-byte words)."""
        p = (self.percent / 100) ** MIN_DEPTH
        return 4 * math.ceil(math.log(MISSED) / math.log(1 - p) / 4) if p < 1 else 4

    @property
    def minhashes(self) -> int:
        return self.trees * DEPTH

    @property
    def min_equal(self) -> int:
        """Least number of equal 2-bit values of two sketches."""
        p = self.percent / 100 + (1 - self.percent / 100) / 4
        return int(self.minhashes * p - 5 * (self.minhashes * p * (1 - p)) ** 0.5)


def shingle_hashes(words: np.ndarray, cut: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles of many texts (with repeats), and offsets."""
    n = np.diff(cut)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_cut = np.concatenate(([0], np.cumsum(count)))
    odd = [np.uint64(int.from_bytes(xxhash.xxh3_64_digest(bytes([k, width])), "big") | 1) for k in range(width)]
    if len(words) >= width:
        h = sum(words[k : len(words) - width + 1 + k] * odd[k] for k in range(width))
        first = np.repeat(cut[:-1] - out_cut[:-1], count) + np.arange(out_cut[-1])
        h = fmix64(h[np.minimum(first, len(h) - 1)])
    else:
        h = np.zeros(out_cut[-1], np.uint64)
    for i in np.flatnonzero((n > 0) & (n < width)):
        w = words[cut[i] : cut[i + 1]]
        h[out_cut[i]] = fmix64(np.array([sum(int(x) * int(o) for x, o in zip(w, odd)) + len(w) & (1 << 64) - 1], np.uint64))[0]
    return h, out_cut


class MinHasher:
    def __init__(self, n: int):
        rng = np.random.default_rng(85)
        self.n = n
        self.flip = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        self.odd = rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)

    def __call__(self, shingles: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """One row of big-endian minhashes per text; all ones for empty sets."""
        out = np.full((len(cut) - 1, self.n), 0xFFFFFFFF, ">u4")
        full = np.flatnonzero(np.diff(cut))
        if len(full):
            x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
            for k in range(self.n):
                out[full, k] = np.minimum.reduceat((x ^ self.flip[k]) * self.odd[k], cut[full])
        return out


def _sketch(minhashes: np.ndarray) -> np.ndarray:
    """The lowest two bits of every minhash, packed into bytes."""
    low = (minhashes & 3).astype(np.uint8).reshape(len(minhashes), -1, 4)
    return (low << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2, dtype=np.uint8)


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal 2-bit values of sketches (rows of 8-byte words)."""
    x = a ^ b
    return 32 * x.shape[-1] - np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=-1, dtype=np.int64)


def _near(n_a, n_b, percent: int) -> np.ndarray:
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def _signatures(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, minhash = WordHasher(), MinHasher(rule.minhashes)
    for b in batches:
        size, fp1, fp2, sig, sketch = [], [], [], [], []
        for _, texts in chunked(text_bytes(b)):
            h, cut = shingle_hashes(*hasher(texts), rule.width)
            rows = minhash(h, cut)
            sig += [r.tobytes() for r in rows]
            sketch += [r.tobytes() for r in _sketch(rows)]
            for i in range(len(texts)):
                own = np.unique(h[cut[i] : cut[i + 1]])
                fp = xxhash.xxh3_128_intdigest(own.tobytes())
                size.append(len(own))
                fp1.append((fp >> 64) - (1 << 63))
                fp2.append((fp & (1 << 64) - 1) - (1 << 63))
        cols = [column(b, "doc_id"), *(pa.array(x, pa.int64()) for x in (size, fp1, fp2)), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_shingles", "fp1", "fp2", "sig", "sketch"])


def _fixed(col: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal widths as rows of bytes."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, width)


_EVENT = ["kind", "region", "a", "b", "n", "sketch"]


def _neighbours(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows in sorted order: 'pair' for neighbours in a region of the first
    trees, 'member' for all rows of regions with more than one row here, and for
    the first and last row, whose regions may go on in another partition."""
    tail = None
    width = 1 + 4 * DEPTH

    def rows(b: pa.RecordBatch):
        return (
            _fixed(column(b, "key"), width), np.asarray(column(b, "node")), np.asarray(column(b, "n")),
            _fixed(column(b, "sketch"), rule.minhashes // 4).copy().view(np.uint64),
        )

    def emit(part, member, same):
        key, node, n, sketch = part
        i = np.flatnonzero(same & (key[1:, 0] < FIRST_TREES))
        if len(i):
            i = i[_near(n[i], n[i + 1], rule.percent) & (_equal(sketch[i], sketch[i + 1]) >= rule.min_equal) & (node[i] != node[i + 1])]
        m = np.flatnonzero(member)
        k, z = len(i), len(m)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(["pair"] * k + ["member"] * z, pa.string()),
                pa.array([None] * k + [r.tobytes() for r in key[m, :_PREFIX]], pa.binary()),
                pa.array(np.concatenate([node[i], node[m]]), pa.int64()),
                pa.array(np.concatenate([node[i + 1], node[m]]), pa.int64()),
                pa.array(np.concatenate([n[i], n[m]]), pa.int64()),
                pa.array([None] * k + [r.tobytes() for r in sketch[m]], pa.binary()),
            ],
            names=_EVENT,
        )

    open_before = True  # the row held back belongs to a region seen before, or is the first
    for b in batches:
        if not b.num_rows:
            continue
        part = rows(b)
        if tail is not None:
            part = tuple(np.concatenate([x, y]) for x, y in zip(tail, part))
        key = part[0]
        same = (key[1:, :_PREFIX] == key[:-1, :_PREFIX]).all(axis=1)
        member = np.zeros(len(key), bool)
        member[1:] |= same
        member[:-1] |= same
        member[0] |= open_before
        open_before = bool(member[-1]) if len(key) > 1 else open_before
        member[-1] = False  # decided with the next batch, or at the end
        yield emit(part, member, same)
        tail = tuple(x[-1:] for x in part)
    if tail is not None:
        yield emit(tail, np.ones(1, bool), np.zeros(0, bool))


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sets, given as sorted arrays."""
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = _common(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def _settle_block(rule: Rule, rows: list[tuple]) -> list[tuple[int, int]]:
    """Links that join different components of a block, likeliest pairs first.
    A pair that shares a region in an earlier tree is settled there."""
    _, tree, node, comp, n, side, sketch, shingles, prefixes = zip(*rows, strict=True)
    node, n, side = np.array(node), np.array(n), np.array(side)
    sketch = np.frombuffer(b"".join(sketch), np.uint64).reshape(len(rows), -1)
    prefixes = np.frombuffer(b"".join(prefixes), f"V{4 * MIN_DEPTH}").reshape(len(rows), rule.trees)[:, : tree[0]]
    ids = {c: i for i, c in enumerate(dict.fromkeys(comp))}
    comp = np.array([ids[c] for c in comp])
    two = side.any() and not side.all()
    percent, min_equal = rule.percent, rule.min_equal
    found = []
    for i in range(len(rows) - 1):
        ok = (comp[i + 1 :] != comp[i]) & _near(n[i + 1 :], n[i], percent)
        if two:
            ok &= side[i + 1 :] != side[i]
        j = np.flatnonzero(ok) + i + 1
        if len(j):
            equal = _equal(sketch[j], sketch[i])
            j, equal = j[equal >= min_equal], equal[equal >= min_equal]
        if len(j) and tree[0]:
            new = ~(prefixes[j] == prefixes[i]).any(axis=1)
            j, equal = j[new], equal[new]
        if len(j):
            found.append(np.stack([np.full(len(j), i), j, equal], axis=1))
    if not found:
        return []
    found = np.concatenate(found)
    sets = [np.frombuffer(x, np.uint64) for x in shingles]
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for i, j, _ in found[np.argsort(-found[:, 2], kind="stable")].tolist():
        x, y = find(comp[i]), find(comp[j])
        if x != y and _linked(sets[i], sets[j], percent):
            root[x] = y
            links.append((int(node[i]), int(node[j])))
    return links


_BLOCK_COLS = ("block", "tree", "node", "comp", "n", "side", "sketch", "shingles", "prefixes")


def _settle(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_settle_block`` for every block of a partition sorted by block."""

    def out(links):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    held: list[tuple] = []
    for batch in batches:
        for r in zip(*(column(batch, c).to_pylist() for c in _BLOCK_COLS), strict=True):
            if held and held[0][0] != r[0]:
                if len(held) > 1:
                    yield out(_settle_block(rule, held))
                held = []
            held.append(r)
    if len(held) > 1:
        yield out(_settle_block(rule, held))


def _sets(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets, and the least-depth prefix of every tree."""
    hasher, minhash = WordHasher(), MinHasher(rule.minhashes)
    for b in batches:
        out, prefixes = [], []
        for _, texts in chunked(text_bytes(b)):
            h, cut = shingle_hashes(*hasher(texts), rule.width)
            heads = minhash(h, cut).reshape(len(texts), rule.trees, DEPTH)[:, :, :MIN_DEPTH]
            out += [np.unique(h[cut[i] : cut[i + 1]]).tobytes() for i in range(len(texts))]
            prefixes += [x.tobytes() for x in heads]
        cols = [column(b, "doc_id"), pa.array(out, pa.binary()), pa.array(prefixes, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["node", "shingles", "prefixes"])


def _confirm(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = zip(column(b, "set_a").to_pylist(), column(b, "set_b").to_pylist(), strict=True)
        keep = pa.array([_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), rule.percent) for x, y in both], pa.bool_())
        yield pa.RecordBatch.from_arrays([column(b, c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(partial(_confirm, rule), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark, rule = docs.sparkSession, Rule(width, percent)
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(rows.mapInArrow(partial(_signatures, rule), "doc_id long, n_shingles long, fp1 long, fp2 long, sig binary, sketch binary"), "dd-signed")
    classes = materialize(signed.where("n_shingles > 0").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("node")), "dd-classes")
    # the rows that stand for their class: its smallest id
    firsts = signed.where("n_shingles > 0").join(
        classes.select(F.col("node").alias("doc_id"), "fp1", "fp2"), ["doc_id", "fp1", "fp2"], "left_semi"
    )
    trees = firsts.select(
        F.col("doc_id").alias("node"),
        F.col("n_shingles").alias("n"),
        "sketch",
        F.explode(F.array(*[
            F.concat(F.unhex(F.lit(f"{t:02x}")), F.substring("sig", 4 * DEPTH * t + 1, 4 * DEPTH)) for t in range(rule.trees)
        ])).alias("key"),
    )
    trees = materialize(trees, "dd-forest")
    in_order = trees.repartitionByRange(shuffle_partitions(spark), "key", "node").sortWithinPartitions("key", "node")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8192")
    events = materialize(in_order.mapInArrow(partial(_neighbours, rule), "kind string, region binary, a long, b long, n long, sketch binary"), "dd-events")
    release(trees)
    small_batches(spark)
    members = events.where("kind = 'member'").select("region", F.col("a").alias("node"), "n", "sketch")
    # sets of all documents that share a region with another one
    crowded = members.groupBy("region").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("region")
    nodes = members.join(crowded, "region", "left_semi").select(F.col("node").alias("doc_id")).distinct()
    sets = materialize(rows.join(materialize(nodes, "dd-nodes"), "doc_id", "left_semi").mapInArrow(partial(_sets, rule), "node long, shingles binary, prefixes binary"), "dd-sets")

    first_pairs = events.where("kind = 'pair'").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first_pairs = materialize(first_pairs, "dd-pairs")
    first_links = materialize(confirmed(first_pairs, sets, rule), "dd-links")
    first = materialize(components(first_links), "dd-first").withColumnRenamed("node", "_n")

    placed = members.join(first, F.col("node") == F.col("_n"), "left")
    placed = materialize(placed.select("region", "node", "n", "sketch", F.coalesce("component", "node").alias("comp")), "dd-placed")
    mixed = placed.groupBy("region").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("_size"))
    mixed = materialize(mixed.where("_lo <> _hi").select("region", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_blocks")), "dd-mixed")
    mine = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda j: F.struct(F.least(j, mine).alias("i"), F.greatest(j, mine).alias("j"), (j < mine).alias("side")),
    )
    dealt = placed.join(mixed, "region").select("region", "node", "n", "sketch", "comp", F.explode(blocks).alias("_b"))
    block = F.concat("region", F.concat_ws("/", F.lit(""), "_b.i", "_b.j").cast("binary"))
    tree = F.conv(F.hex(F.substring("region", 1, 1)), 16, 10).cast("int")
    dealt = dealt.select(block.alias("block"), tree.alias("tree"), "node", "comp", "n", "_b.side", "sketch").join(sets, "node")
    by_block = dealt.select(*_BLOCK_COLS).repartition("block").sortWithinPartitions("block", "node")
    more_links = materialize(by_block.mapInArrow(partial(_settle, rule), "a long, b long"), "dd-links")
    for t in (sets, events, placed, mixed, first_pairs):
        release(t)

    final = materialize(components(first_links.union(more_links)), "dd-final")
    whole = classes.join(final, "node", "left").select("fp1", "fp2", F.coalesce("component", "node").alias("_component"))
    out = signed.select("doc_id", "n_shingles", "fp1", "fp2").join(materialize(whole, "dd-whole"), ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def q_near_dedup(spark, sf_dir: str) -> DataFrame:
    """op3: set size, component and verdict of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Exact links by a join on shingles; fine at the oracle's small scale.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w),
sizes AS (SELECT doc_id, len(sh) AS n, CASE WHEN len(sh) > 0 THEN md5(array_to_string(list_sort(sh), chr(10))) END AS fp FROM s),
classes AS (SELECT fp, min(doc_id) AS node, any_value(n) AS n FROM sizes WHERE fp IS NOT NULL GROUP BY fp),
e AS (SELECT doc_id AS node, unnest(sh) AS sh FROM s WHERE doc_id IN (SELECT node FROM classes)),
rare AS (SELECT sh FROM e GROUP BY sh HAVING count(*) > 1),
x AS (SELECT e.node, e.sh FROM e JOIN rare USING (sh)),
pairs AS (
  SELECT p.node AS a, q.node AS b, count(*) AS common
  FROM x p JOIN x q ON p.sh = q.sh AND p.node < q.node GROUP BY p.node, q.node),
links AS (
  SELECT a, b FROM pairs JOIN classes ca ON a = ca.node JOIN classes cb ON b = cb.node
  WHERE 100 * common >= 85 * (ca.n + cb.n - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(node, seen) AS (
    SELECT node, node FROM classes
    UNION
    SELECT bw.b, r.seen FROM r JOIN both_ways bw ON bw.a = r.node)
  SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT z.doc_id, z.n::BIGINT AS n_shingles, coalesce(reach.component, z.doc_id) AS component_id,
       z.doc_id = coalesce(reach.component, z.doc_id) AS kept
FROM sizes z LEFT JOIN classes c ON z.fp = c.fp LEFT JOIN reach ON reach.node = c.node
"""
