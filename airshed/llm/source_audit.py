"""Source divergence audit by a recount into minimal perfect hashes.

How far the term use of each source lies from that of the other sources of its
language, and which terms set it apart from the language as a whole.

Method. A first pass counts the documents of every (lang, term) exactly and
keeps the terms of at least ``MIN_DOCS``. A language's kept terms are dealt to
shards of about ``SHARD_KEYS``; each gets a minimal perfect hash (levels of bit
arrays: a key sits at its bit of the first level where no other key wants it,
its slot is the rank of that bit) and its keys in slot order. The hashes are
broadcast, ``ROUND_BYTES`` at a time, and a second pass over the texts finds
each term's slot, verifies it by the key stored there, and increments the
dense slots of its (lang, source) group. All arithmetic is on integers.

Scale. The first pass sends distinct terms per task, the second one slot counts
per task, group and shard; both are summed by (lang, term) or (group, shard), so
a hot language or source spreads over its shards, and a shard's sums are one
vector at a time, first over ``TASKS_SUMMED`` tasks, then over those sums. What is broadcast is bounded by
``ROUND_BYTES`` plus one shard; a larger vocabulary takes more rounds over the
texts. Sources are compared in blocks: a task holds one shard of at most
2 x ``SOURCE_BLOCK`` sources. Every pair of sources of a language is a row of
the result, so that work grows with the squares of their numbers. A group's
terms are cut to ``TOP`` in every shard before they are shuffled for ranking.

Defined cases: null text, lang and source count as ''; a document is a row,
whatever its id; groups without terms count too; a language without kept terms
has pairs of value 0 and no terms; an empty table gives an empty result; ties
rank by the item's UTF-8; only the named columns are read. Values are exact
while a group has fewer than 9 * 10^15 terms and a language fewer than 10^9
kept terms.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import column, fmix64, materialize, release, running_total, table, text_bytes
from airshed.session import shuffle_partitions

MIN_DOCS, TOP = 3, 200
SCALE = 1_000_000_000
SHARD_KEYS, SOURCE_BLOCK = 1 << 14, 64
ROUND_BYTES = 64 << 20
#: Distinct terms (by language) and terms' slots that a task holds.
HELD_TERMS, HELD_SLOTS = 400_000, 4_000_000
#: Terms that are looked up together.
LOOKED_UP = 300_000
#: Tasks whose slots are first added up together.
TASKS_SUMMED = 64

#: Letters stay (A-Z in lower case), other ASCII becomes a blank, the bytes of
#: all other characters stay.
_FOLD = bytes(c if c > 127 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z in lower case."""
    return text.translate(_FOLD).split()


# ---------------------------------------------------------------------------
# Minimal perfect hash
# ---------------------------------------------------------------------------

_LEVELS, _SPREAD = 24, np.uint64(0x9E3779B97F4A7C15)


def key_hash(key: bytes) -> int:
    """As Spark's xxhash64 of a string (without its sign)."""
    return xxhash.xxh64_intdigest(key, 42)


class PerfectHash:
    """Slots 0..n-1 of n distinct keys. ``find`` gives a key's slot, or -1 for
    any other key, as the key stored at the slot decides."""

    def __init__(self, keys: list[bytes]):
        left = np.array(sorted(keys), object)
        hashes = np.fromiter(map(key_hash, left), np.uint64, len(left))
        self.bits: list[np.ndarray] = []
        stored: list[np.ndarray] = []
        while len(left) and len(self.bits) < _LEVELS:
            size = 2 * len(left) + 1
            at = self._at(hashes, len(self.bits), size)
            alone = np.bincount(at, minlength=size) == 1
            sits = alone[at]
            self.bits.append(alone)
            stored.append(left[sits][np.argsort(at[sits])])
            left, hashes = left[~sits], hashes[~sits]
        self.keys: list[bytes] = [k for level in stored for k in level]
        self.rest = {k: len(self.keys) + i for i, k in enumerate(left)}  # keys that share all their hashes
        self.keys += left.tolist()
        self._rank()

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (fmix64(hashes + np.uint64(level + 1) * _SPREAD) % np.uint64(size)).astype(np.int64)

    def _rank(self) -> None:
        before = np.cumsum([0, *(int(b.sum()) for b in self.bits)])
        self.ranks = [np.cumsum(b) - 1 + n for b, n in zip(self.bits, before)]

    def dumps(self) -> bytes:
        return pickle.dumps(([(len(b), np.packbits(b).tobytes()) for b in self.bits], self.keys, self.rest))

    @classmethod
    def loads(cls, data: bytes) -> PerfectHash:
        out = cls.__new__(cls)
        packed, out.keys, out.rest = pickle.loads(data)
        out.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in packed]
        out._rank()
        return out

    def find(self, keys: list[bytes], hashes: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.bits, self.ranks)):
            at = self._at(hashes[open_], level, len(bits))
            hit = bits[at]
            slot[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        for i in open_.tolist():
            slot[i] = self.rest.get(keys[i], -1)
        stored = self.keys
        for i, s in enumerate(slot.tolist()):
            if s >= 0 and stored[s] != keys[i]:
                slot[i] = -1
        return slot


# ---------------------------------------------------------------------------
# Tasks
# ---------------------------------------------------------------------------


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text -> documents of every term, by lang, summed in this task."""
    held: dict[str, Counter] = defaultdict(Counter)

    def flush():
        for lang, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "term", "n"])
        held.clear()

    size = 0
    for b in batches:
        for lang, text in zip(column(b, "lang").to_pylist(), text_bytes(b)):
            of = held[lang]
            size -= len(of)
            of.update(set(terms(text)))
            size += len(of)
            if size > HELD_TERMS:
                yield from flush()
                size = 0
    yield from flush()


def _build(key: tuple, group: pa.Table) -> pa.Table:
    keys = [t.encode() for t in group.column("term").to_pylist()]
    index = PerfectHash(keys)
    names = [k.decode() for k in index.keys]
    return pa.table({
        "lang": pa.array([key[0].as_py()]), "shard": pa.array([key[1].as_py()], pa.int64()), "shards": group.column("shards").slice(0, 1),
        "keys": pa.array([names], pa.list_(pa.string())), "index": pa.array([index.dumps()], pa.binary()),
    })


SLOTS = "slots array<int>, counts array<long>"


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def _slot_rows(keys: list[tuple], names: list[str], vectors: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of keys and of the slots of a vector that are not 0."""
    used = [np.flatnonzero(v) for v in vectors]
    kinds = [pa.int64() if n in ("shard", "salt") else pa.string() for n in names]
    columns = [pa.array(c, k) for c, k in zip(zip(*keys), kinds)]
    columns += [_lists(used, pa.int32()), _lists([v[u] for v, u in zip(vectors, used)], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=[*names, "slots", "counts"])


def _recount(shared):
    """lang, source, text -> lang, source, shard, slots, counts of the
    broadcast shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes: dict[tuple, PerfectHash] = {}
        shards: dict[str, int] = {}
        for lang, shard, of, index in shared.value:
            indexes[lang, shard] = PerfectHash.loads(index)
            shards[lang] = of
        starts: dict[str, dict[int, int]] = defaultdict(dict)  # a language's shards, one after another
        width: dict[str, int] = defaultdict(int)
        for lang, shard in sorted(indexes):
            starts[lang][shard] = width[lang]
            width[lang] += len(indexes[lang, shard].keys)
        place: dict[str, dict[bytes, int]] = defaultdict(dict)  # slots of terms seen of late; -1: none
        held: dict[tuple, list[np.ndarray]] = defaultdict(list)  # slots of a group's terms

        def learn(lang: str, new: list[bytes]) -> None:
            hashes = np.fromiter(map(key_hash, new), np.uint64, len(new))
            at = hashes.view(np.int64) % shards[lang]
            order = np.argsort(at, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                shard, keys = int(at[some[0]]), [new[i] for i in some.tolist()]
                if shard in starts[lang]:
                    slot = indexes[lang, shard].find(keys, hashes[some])
                    slot[slot >= 0] += starts[lang][shard]
                else:  # another round's
                    slot = np.full(len(keys), -1)
                place[lang].update(zip(keys, slot.tolist()))

        def flush():
            for (lang, source), found in held.items():
                at, wide = np.concatenate(found), width[lang]
                if len(at) * 8 >= wide:
                    dense = np.bincount(at, minlength=wide)
                    used = np.flatnonzero(dense)
                    times = dense[used]
                else:  # few of very many slots
                    used, times = np.unique(at, return_counts=True)
                own = sorted(starts[lang].items(), key=lambda x: x[1])
                edge = np.searchsorted(used, [at for _, at in own] + [wide])
                rows = [(k, used[i:j] - first, times[i:j]) for (k, first), i, j in zip(own, edge, edge[1:]) if j > i]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows)), pa.array([source] * len(rows)), pa.array([k for k, _, _ in rows], pa.int64()),
                         _lists([s for _, s, _ in rows], pa.int32()), _lists([n for _, _, n in rows], pa.int64())],
                        names=["lang", "source", "shard", "slots", "counts"],
                    )
            held.clear()

        def place_terms(lang: str, texts: list[tuple[str, list[bytes]]]) -> None:
            known = place[lang]
            if len(known) > HELD_TERMS:
                known.clear()
            if new := list(set().union(*(found for _, found in texts)).difference(known)):
                learn(lang, new)
            for source, found in texts:
                at = np.fromiter(map(known.__getitem__, found), np.int32, len(found))
                held[lang, source].append(at[at >= 0])

        waiting: dict[str, list] = defaultdict(list)  # by language: terms are looked up many at a time
        n_waiting, size = 0, 0
        for b in batches:
            for lang, source, text in zip(column(b, "lang").to_pylist(), column(b, "source").to_pylist(), text_bytes(b)):
                if lang not in shards:
                    continue
                found = terms(text)
                waiting[lang].append((source, found))
                n_waiting += len(found)
                if n_waiting > LOOKED_UP:
                    for at_once in waiting.items():
                        place_terms(*at_once)
                    waiting.clear()
                    size, n_waiting = size + n_waiting, 0
                    if size > HELD_SLOTS:
                        yield from flush()
                        size = 0
        for at_once in waiting.items():
            place_terms(*at_once)
        yield from flush()

    return run


def _sum_slots(names: list[str]):
    """Rows sorted by ``names`` -> one row for each, their slots added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, dense = None, np.zeros(0, np.int64)
        for b in batches:
            slots, counts = column(b, "slots"), column(b, "counts")
            for i, key in enumerate(zip(*(column(b, n).to_pylist() for n in names))):
                if key != before:
                    if before is not None:
                        yield _slot_rows([before], names, [dense])
                    before, dense = key, np.zeros(0, np.int64)
                at, n = slots[i].values.to_numpy(), counts[i].values.to_numpy()
                if len(at) and at[-1] >= len(dense):
                    dense = np.concatenate((dense, np.zeros(at[-1] + 1 - len(dense), np.int64)))
                dense[at] += n
        if before is not None:
            yield _slot_rows([before], names, [dense])

    return run


def _scaled(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in thousands."""
    out, rest = np.zeros(len(counts), np.int64), counts + 1
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + whole
    return out + 1


def _pair_sums(key: tuple, group: pa.Table) -> pa.Table:
    """One shard of two blocks of sources -> its share of all their pair values."""
    block, other = key[2].as_py(), key[3].as_py()
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("rank", "total", "width", "slots", "counts")), strict=True))
    ranks = [r[0] for r in rows]
    share = np.empty((len(rows), rows[0][2]), np.int64)
    for i, (_, total, width, slots, counts) in enumerate(rows):
        dense = np.zeros(width, np.int64)
        if slots:
            dense[slots] = counts
        share[i] = _scaled(dense, total)
    mine, theirs, value = [], [], []
    for i, rank in enumerate(ranks):
        if block == other:
            with_ = [k for k in range(len(ranks)) if k != i]
        else:
            with_ = [k for k, r in enumerate(ranks) if r // SOURCE_BLOCK != rank // SOURCE_BLOCK]
        for k in with_:
            apart = share[i] - share[k]
            mine.append(rank)
            theirs.append(ranks[k])
            value.append(int((apart * apart // share[k]).sum()))
    lang = pa.array([key[0].as_py()] * len(mine), pa.string())
    return pa.table({"lang": lang, "rank": pa.array(mine, pa.int64()), "other": pa.array(theirs, pa.int64()), "value": pa.array(value, pa.int64())})


def _top_terms(top: int):
    """By lang and shard: a row with the shard's keys and the language's counts
    (kind 0), then the rows of its sources -> the shard's ``top`` terms of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, counts, names = column(b, "slots"), column(b, "counts"), column(b, "keys")
            heads = zip(*(column(b, n).to_pylist() for n in ("kind", "lang", "source", "total")))
            for i, (kind, lang, source, total) in enumerate(heads):
                at, n = slots[i].values.to_numpy(), counts[i].values.to_numpy()
                if kind == 0:
                    keys = names[i].values
                    share = np.zeros(len(keys), np.int64)
                    share[at] = _scaled(n, total)
                    continue
                p, q = _scaled(n, total), share[at]
                above = p > q
                at, apart, q = at[above], (p - q)[above], q[above]
                value = apart * apart // q
                if len(value) > top:  # ties with the last place stay until the items decide
                    least = np.partition(value, -top)[-top]
                    at, value = at[value >= least], value[value >= least]
                found = sorted(zip((-value).tolist(), (k.encode() for k in keys.take(pa.array(at)).to_pylist())))[:top]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array([source] * len(found), pa.string()), pa.array([k.decode() for _, k in found], pa.string()), pa.array([-v for v, _ in found], pa.int64())],
                    names=["lang", "source", "item", "value"],
                )

    return run


# ---------------------------------------------------------------------------
# Plan
# ---------------------------------------------------------------------------


def _vocabulary(docs: DataFrame, min_docs: int, shard_keys: int) -> DataFrame:
    """lang, shard, shards, keys, index: the perfect hash of every shard."""
    found = docs.select("lang", "text").mapInArrow(_document_terms, "lang string, term string, n long")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")
    kept = materialize(kept, "audit-terms")
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("term") / shard_keys).alias("shards"))
    dealt = kept.join(sizes, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))
    built = dealt.groupBy("lang", "shard").applyInArrow(_build, "lang string, shard long, shards long, keys array<string>, index binary")
    out = materialize(built, "audit-shards")
    release(kept)
    return out


def _counts(docs: DataFrame, shards: DataFrame, round_bytes: int) -> DataFrame:
    """lang, source, shard, slot, n: terms of every group, from as many rounds
    over the texts as the broadcast shards need."""
    spark = docs.sparkSession
    sized = shards.select("lang", "shard", "shards", "index", F.length("index").cast("long").alias("bytes"))
    dealt = running_total(sized, ["lang", "shard"], "bytes", "before").withColumn("round", F.floor(F.col("before") / round_bytes))
    dealt = materialize(dealt, "audit-rounds")
    group = ["lang", "source", "shard"]
    kind = f"lang string, source string, shard long, {SLOTS}"
    rounds = []
    for number in range((dealt.agg(F.max("round")).first()[0] or 0) + 1):
        rows = dealt.where(F.col("round") == number).select("lang", "shard", "shards", "index")
        shared = spark.sparkContext.broadcast([tuple(r) for r in rows.collect()])  # at most round_bytes and one shard
        found = docs.select("lang", "source", "text").mapInArrow(_recount(shared), kind)
        found = found.withColumn("salt", F.floor(F.spark_partition_id() / TASKS_SUMMED))
        rounds.append(materialize(_summed(_summed(found, [*group, "salt"]), group), "audit-counts"))
        shared.unpersist()
    release(dealt)
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def _summed(found: DataFrame, names: list[str]) -> DataFrame:
    n = shuffle_partitions(found.sparkSession)
    kinds = ", ".join(f"{c} {'long' if c in ('shard', 'salt') else 'string'}" for c in names)
    dealt = found.select(*names, "slots", "counts").repartition(n, *names).sortWithinPartitions(*names)
    return dealt.mapInArrow(_sum_slots(names), f"{kinds}, {SLOTS}")


def audit(
    documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard_keys: int = SHARD_KEYS, round_bytes: int = ROUND_BYTES
) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources of the language
    by distance (part ``pair``), and the terms that the group uses more than
    its language by distance (part ``term``, up to ``top``)."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = documents.select(told("text"), told("lang"), told("source"))
    shards = _vocabulary(docs, min_docs, shard_keys)
    counts = _counts(docs, shards, round_bytes)

    widths = shards.select("lang", "shard", F.size("keys").alias("width"))
    sizes = widths.groupBy("lang").agg(F.sum("width").alias("v"))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    used = counts.groupBy("lang", "source").agg(F.sum(total).alias("n"))
    groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(sizes, "lang", "left")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), rank.cast("long").alias("rank"))
    groups = materialize(groups, "audit-groups")

    result = _pairs(groups, widths, counts).unionByName(_terms(groups, shards, counts, top))
    return result.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


def _pairs(groups: DataFrame, widths: DataFrame, counts: DataFrame) -> DataFrame:
    dense = groups.join(widths, "lang").join(counts, ["lang", "source", "shard"], "left")
    blocks = groups.groupBy("lang").agg(F.floor(F.max("rank") / SOURCE_BLOCK).alias("last"))
    own = F.floor(F.col("rank") / SOURCE_BLOCK)
    partners = F.transform(F.sequence(F.lit(0).cast("long"), F.col("last")), lambda x: F.struct(F.least(x, own).alias("block"), F.greatest(x, own).alias("other")))
    dealt = dense.join(blocks, "lang").select(
        "lang", "shard", "rank", (F.col("n") + F.col("v")).alias("total"), "width",
        "slots", "counts", F.inline(partners),
    )
    kind = "lang string, rank long, other long, value long"
    sums = dealt.groupBy("lang", "shard", "block", "other").applyInArrow(_pair_sums, kind)
    sums = sums.groupBy("lang", "rank", "other").agg(F.sum("value").alias("value"))
    left = groups.select("lang", "source", "rank")
    right = groups.select("lang", F.col("source").alias("item"), F.col("rank").alias("other"))
    pairs = left.join(right, "lang").where("rank <> other").join(sums, ["lang", "rank", "other"], "left")
    value = F.coalesce("value", F.lit(0))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(value.desc(), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"), place.alias("rank"))


def _terms(groups: DataFrame, shards: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    n = shuffle_partitions(groups.sparkSession)
    langs = groups.groupBy("lang").agg((F.sum("n") + F.max("v")).alias("total"))
    whole = _summed(counts, ["lang", "shard"]).join(shards.select("lang", "shard", "keys"), ["lang", "shard"]).join(langs, "lang")
    own = counts.join(groups.select("lang", "source", (F.col("n") + F.col("v")).alias("total")), ["lang", "source"])
    cols = ["lang", "shard", "kind", "source", "total", "slots", "counts", "keys"]
    heads = whole.select("lang", "shard", F.lit(0).alias("kind"), F.lit("").alias("source"), "total", "slots", "counts", "keys")
    rows = own.select("lang", "shard", F.lit(1).alias("kind"), "source", "total", "slots", "counts", F.lit(None).cast("array<string>").alias("keys"))
    both = heads.select(*cols).unionByName(rows.select(*cols)).repartition(n, "lang", "shard").sortWithinPartitions("lang", "shard", "kind")
    best = both.mapInArrow(_top_terms(top), "lang string, source string, item string, value long")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return best.withColumn("rank", place).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def q_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: divergence of every source from the others of its language."""
    return audit(table(spark, sf_dir, "documents"))


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
used AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM docs)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) USING (lang, source) LEFT JOIN sizes USING (lang)),
shares AS (
  SELECT g.lang, g.source, term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p
  FROM groups g JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)),
lang_shares AS (
  SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 1) // (any_value(lang_n) + any_value(v)) AS q
  FROM shares JOIN (SELECT lang, sum(n) AS lang_n, any_value(v) AS v FROM groups GROUP BY lang) USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q AS value, row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term) AS rank
    FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q) WHERE rank <= 200)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
