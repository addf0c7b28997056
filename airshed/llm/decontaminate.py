"""Benchmark decontamination by latent semantic retrieval.

1. Passages: WINDOW words around an anchor; anchors are the words whose hash
   is the least of some run of ANCHOR_RUN words, so a passage and its copy
   have the same anchors wherever they stand.
2. The words of every document are hashed into buckets once and kept in a scratch
   table. Document frequencies are counted over all of it, and
   every document and item fits the latent space: a randomised SVD of the
   TF-IDF matrix of their consecutive passages, by subspace iteration. Each step
   is a Spark job over all texts that sums the tasks' products by blocks of
   buckets and returns the sum alone (buckets x RANK).
3. Every passage of every document is folded into the latent space and
   compared with all benchmark passages by cosine; none is left out before.
   Items of fewer than SHORT_ITEM words may have no whole passage inside them:
   these are candidates wherever one of their words stands in its place and
   the region has words enough, each counted as often as the item has it.
4. Each candidate is aligned with its item; the longest common subsequence of
   the aligned region and the whole item decides: LCS_SURE of the item's words,
   or LCS_PARAPHRASE of them if the answer, the item's last sentence, is there
   too. Regions with fewer than LCS_PARAPHRASE words of the item, in any order
   and with repeats, can't reach either and are left out before.

The benchmark is searched in blocks of about BLOCK_ITEMS items, each sent to the tasks
with its size bounded by that; the texts are read once per block, nothing is shuffled.

Defined cases: null or empty texts and items match nothing, nor do items of
fewer than MIN_ITEM words; repeated rows and ids are searched each, the result
has one row per (doc_id, item_id) with the best match; null ids stay null; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import (
    CHUNK_BYTES,
    NOT_ALNUM,
    WordHasher,
    chunked,
    column,
    fmix64,
    materialize,
    release,
    small_batches,
    table,
    text_bytes,
)

WINDOW, ANCHOR_RUN = 12, 8
BITS, RANK = 13, 48
ITERATIONS = 2
MIN_COSINE = 0.7
LCS_SURE, LCS_PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
MIN_ITEM = 6
SHORT_ITEM = WINDOW + ANCHOR_RUN
BLOCK_ITEMS = 2000
SUM_TASKS = 8
#: Tasks of a step of the fit, by core: each sends its product on.
FIT_WAVES = 8
#: Texts, passages and cosines that one numpy pass works on.
TEXTS_MARKED, COMPARED, CELLS = 128, 2048, 1 << 18

_SHIFT = np.uint64(64 - BITS)


def anchors(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Positions of the words that are the least of some run of ANCHOR_RUN."""
    if len(h) < ANCHOR_RUN:
        return np.arange(len(h))[:0] if not len(h) else np.unique(_least_by_text(h, cut))
    low = h
    width = 1
    while width < ANCHOR_RUN:  # running minima by doubling
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    top = np.concatenate([np.zeros(ANCHOR_RUN - 1, np.uint64), low, np.zeros(ANCHOR_RUN - 1, np.uint64)])
    width = 1
    while width < ANCHOR_RUN:
        top = np.maximum(top[: len(top) - width], top[width:])
        width *= 2
    chosen = top[: len(h)] == h
    chosen[_least_by_text(h, cut)] = True
    return np.flatnonzero(chosen)


def _least_by_text(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """One anchor at least for every text: its least word."""
    full = np.flatnonzero(np.diff(cut))
    if not len(full):
        return np.zeros(0, np.int64)
    least = np.minimum.reduceat(h, cut[full])
    hit = np.flatnonzero(h == np.repeat(least, np.diff(cut)[full]))
    return hit


def passages(h: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first word, end) of every passage, inside its text."""
    at = anchors(h, cut)
    text = np.searchsorted(cut, at, side="right") - 1
    return at, np.maximum(at - WINDOW // 2, cut[text]), np.minimum(at + WINDOW // 2, cut[text + 1])


def _rows(buckets: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Distinct word buckets of passages, sorted; the bucket past the last one
    fills up short passages and stands for repeated words."""
    at = first[:, None] + np.arange(WINDOW)
    rows = buckets.take(at, mode="clip")
    rows[at >= end[:, None]] = 1 << BITS
    rows.sort(axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = 1 << BITS
    return rows


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of each text's words, two bytes each, and the text's size."""
    hasher = WordHasher(NOT_ALNUM)
    for b in batches:
        rows: list[bytes] = []
        whole = text_bytes(b)
        for _, texts in chunked(whole):
            h, cut = hasher(texts)
            words = (h >> _SHIFT).astype("<u2").tobytes()
            rows += [words[2 * s : 2 * e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(map(len, whole), pa.int64())], names=["words", "size"])


def _chunks(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, where each text begins) of some of a batch's texts at a time, as
    many as ``chunked`` gives of the texts themselves."""
    rows = column(b, "words").to_pylist()
    for k, sizes in chunked(map(range, column(b, "size").to_pylist()), CHUNK_BYTES):
        words = rows[k : k + len(sizes)]
        yield np.frombuffer(b"".join(words), "<u2").astype(np.int32), np.cumsum([0, *(len(w) >> 1 for w in words)])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each bucket; bucket -1 is the number of documents."""
    df, n = np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        for buckets, cut in _chunks(b):
            texts = len(cut) - 1
            doc = np.repeat(np.arange(texts), np.diff(cut))
            for k in range(0, texts, TEXTS_MARKED):
                part = slice(*np.searchsorted(doc, [k, k + TEXTS_MARKED]))
                seen = np.zeros((min(TEXTS_MARKED, texts - k), 1 << BITS), np.uint8)
                seen[doc[part] - k, buckets[part]] = 1
                df += seen.sum(axis=0, dtype=np.uint32)
            n += texts
    have = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(have, -1), pa.int64()), pa.array(np.append(df[have], n), pa.int64())], names=["bucket", "n"]
    )


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def consecutive(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end) of the passages that follow each other in each text;
    every word is in one."""
    number = -(-np.diff(cut) // WINDOW)
    text = np.repeat(np.arange(len(number)), number)
    first = cut[text] + WINDOW * (np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number))
    return first, np.minimum(first + WINDOW, cut[text + 1])


def _product(idf: np.ndarray, basis: np.ndarray):
    """A task's share of A'A Q for the TF-IDF matrix A of its passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = basis.shape[1]
        weighted = np.vstack([basis * idf[:, None], np.zeros((1, rank))]).astype(np.float32)
        square = np.append(idf, 0.0) ** 2
        out = np.zeros((rank, len(square)))
        for b in batches:
            for words, cut in _chunks(b):
                if not len(words):
                    continue
                ids = _rows(words, *consecutive(cut))
                # equal passages count once, or one text of repeats is a component
                _, once = np.unique(fmix64(ids.astype(np.uint64)).sum(axis=1, dtype=np.uint64), return_index=True)
                ids = ids[once]
                z = np.concatenate([_total(weighted, ids[k : k + COMPARED]) for k in range(0, len(ids), COMPARED)])
                z = z.T / np.maximum(square[ids].sum(axis=1), 1e-12)
                buckets = ids.T.ravel().astype(np.intp)  # once, not in each count
                for r in range(rank):
                    out[r] += np.bincount(buckets, np.tile(z[r], WINDOW), len(square))
        out = out.T[:-1] * idf[:, None]
        blocks = np.split(out.astype(np.float32), SUM_TASKS)
        cols = [pa.array(range(SUM_TASKS), pa.int32()), pa.array([x.tobytes() for x in blocks], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["block", "part"])

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x in zip(column(b, "block").to_pylist(), column(b, "part").to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(x, np.float32).astype(np.float64)
    cols = [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(cols, names=["block", "part"])


def _hashed(texts: DataFrame) -> DataFrame:
    return texts.select("text").mapInArrow(_words, "words binary, size long")


def _fitted(docs: DataFrame, words: DataFrame, items: DataFrame, fit_docs: int | None) -> DataFrame:
    """The words that fit the space: all (``words`` are those of ``docs``), or if asked for items and
    ``fit_docs`` documents by hash of the id (an id may have many rows: so many rows at most)."""
    if fit_docs is not None:
        ids = docs.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
        ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(fit_docs)  # bounded, so it may be broadcast
        docs = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).orderBy(F.xxhash64("_id"), F.xxhash64("text")).limit(fit_docs)
        words = _hashed(docs)
    tasks = FIT_WAVES * docs.sparkSession.sparkContext.defaultParallelism
    return words.coalesce(tasks).union(_hashed(items.coalesce(1)))


def latent_space(docs: DataFrame, items: DataFrame, fit_docs: int | None = None) -> np.ndarray:
    """(2**BITS + 1) x RANK: what a word adds to a passage's latent vector
    (inverse document frequency times right singular vectors over singular
    values); the last row is 0.

    A step multiplies by G = A'A. With the last one, Y = G Q, G is taken as
    Y (Q'Y)^-1 Y' (Nystrom), so the span of Y needs no step of its own."""
    small_batches(docs.sparkSession)
    words = materialize(_hashed(docs), "decontaminate-words")
    counts = words.mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, n_docs = np.zeros(1 << BITS), 0
    for bucket, n in counts.collect():  # one row per bucket
        if bucket < 0:
            n_docs = n
        else:
            df[bucket] = n
    idf = np.log((1 + n_docs) / (1 + df)) + 0.01
    fitted = _fitted(docs, words, items, fit_docs)
    image = np.random.default_rng(48).standard_normal((1 << BITS, RANK))
    for _ in range(ITERATIONS):
        basis, _ = np.linalg.qr(image)
        parts = fitted.mapInArrow(_product(idf, basis), "block int, part binary").repartition(SUM_TASKS, "block")
        summed = parts.mapInArrow(_sum_blocks, "block int, part binary").collect()  # one row per block of buckets
        image = np.zeros_like(basis)
        rows = len(image) // SUM_TASKS
        for block, part in summed:
            image[block * rows : (block + 1) * rows] = np.frombuffer(part).reshape(rows, RANK)
    release(words)
    last, r = np.linalg.qr(image)
    core = basis.T @ image
    values, turn = np.linalg.eigh(r @ np.linalg.pinv((core + core.T) / 2, rcond=1e-6, hermitian=True) @ r.T)  # of G in the span
    values, turn = values[::-1], turn[:, ::-1]
    right = last @ turn / np.sqrt(np.maximum(values, 1e-9 * max(values[0], 1e-9)))
    return np.vstack([right * idf[:, None], np.zeros((1, RANK))]).astype(np.float32)


def _total(space: np.ndarray, ids: np.ndarray) -> np.ndarray:
    total = np.take(space, ids[:, 0], axis=0)
    for column_ in ids.T[1:]:  # a place at a time: no array of passages x words x RANK
        total += np.take(space, column_, axis=0)
    return total


def _fold(space: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return _unit(_total(space, ids))


class Item(NamedTuple):
    item_id: int | None
    words: list[int]
    masks: dict[int, int]  # word -> bits of its places
    need: int  # least number of its words that can be a leak
    answer: int  # words of the last sentence


class Benchmark(NamedTuple):
    items: list[Item]
    queries: np.ndarray  # RANK x passages
    owner: np.ndarray  # item of each passage
    anchor: np.ndarray  # its anchor's place in the item


def prepare(rows: list[tuple[int | None, str | None]], space: np.ndarray) -> Benchmark:
    hasher = WordHasher(NOT_ALNUM)
    items, queries, owner, anchor = [], [], [], []
    for item_id, text in rows:
        h, cut = hasher([(text or "").encode()])
        if len(h) < MIN_ITEM:
            continue
        sentences = [len(hasher([s.encode()])[0]) for s in re.split(r"[.!?\n]", text)]
        answer = next((n for n in reversed(sentences) if n), len(h))
        masks: dict[int, int] = {}
        for i, w in enumerate(h.tolist()):
            masks[w] = masks.get(w, 0) | 1 << i
        if len(h) >= SHORT_ITEM:
            at, first, end = passages(h, cut)
            queries.append(_fold(space, _rows((h >> _SHIFT).astype(np.int32), first, end)))
            owner.append(np.full(len(at), len(items)))
            anchor.append(at)
        need = next(k for k in range(len(h) + 1) if k / len(h) >= LCS_PARAPHRASE)
        items.append(Item(item_id, h.tolist(), masks, need, answer))
    if not queries:
        none = np.zeros(0, np.int64)
        return Benchmark(items, np.zeros((RANK, 0), np.float32), none, none)
    return Benchmark(items, np.concatenate(queries).T.copy(), np.concatenate(owner), np.concatenate(anchor))


def lcs(region: list[int], masks: dict[int, int], n: int) -> int:
    """Length of the longest common subsequence with an item of n words, by
    bits: a clear bit of ``row`` is a place where the length grows."""
    full = (1 << n) - 1
    row = full
    for mask in filter(None, map(masks.get, region)):  # other words change nothing
        hit = row & mask
        row = (row + hit | row - hit) & full
    return n - row.bit_count()


def judge(region: list[int], item: Item) -> tuple[float, bool, bool]:
    """(share of the item found, answer found, is it a leak)."""
    n = len(item.words)
    region = [w for w in region if w in item.masks]
    if len(region) < LCS_PARAPHRASE * n:  # the subsequence can't be longer
        return 0.0, False, False
    share = lcs(region, item.masks, n) / n
    answer = False
    if share >= LCS_PARAPHRASE:
        masks: dict[int, int] = {}
        for i, w in enumerate(item.words[n - item.answer :]):
            masks[w] = masks.get(w, 0) | 1 << i
        answer = lcs(region, masks, item.answer) >= ANSWER * item.answer
    return share, answer, share >= LCS_SURE or (share >= LCS_PARAPHRASE and answer)


def _near(folded: np.ndarray, queries: np.ndarray, least: float, cosines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, query) of all cosines of at least ``least``. ``cosines`` takes
    as many rows at a time as it has: few, so that they stay in the cache."""
    found = []
    near = np.zeros(cosines.size + -cosines.size % 8, bool)
    for k in range(0, len(folded), len(cosines)):
        part = folded[k : k + len(cosines)]
        c = np.matmul(part, queries, out=cosines[: len(part)])
        np.greater_equal(c, least, out=near[: c.size].reshape(c.shape))
        near[c.size :] = False
        eights = np.flatnonzero(near.view(np.uint64))  # few have any: a search of eight flags at a time
        which, flag = np.divmod(np.flatnonzero(near.reshape(-1, 8)[eights]), 8)
        i, j = np.divmod(8 * eights[which] + flag, c.shape[1])
        found.append((k + i, j))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _regions(bench: Benchmark, has: np.ndarray, buckets: np.ndarray, cut: np.ndarray, found: np.ndarray) -> Iterator[tuple]:
    """(item, text, start, lo, hi) of the distinct candidates (item, text, place
    of the item's first word) whose region has words enough to be a leak. That
    is a necessary condition: equal buckets, repeats and order only add."""
    size = np.array([len(x.words) for x in bench.items])
    owner, text, start = found.T
    key = (owner * len(cut) + text) * (len(buckets) + size.max()) + start + size.max()
    owner, text, start = found[np.unique(key, return_index=True)[1]].T
    n = size[owner]
    need = np.array([x.need for x in bench.items])[owner]
    margin = np.maximum(2, n // 4)
    lo, hi = np.maximum(cut[text], start - margin), np.minimum(cut[text + 1], start + n + margin)
    order = np.argsort(lo - hi)
    k = 0
    while k < len(order):  # the widest first, in blocks of bounded size
        width = max(1, int((hi - lo)[order[k]]))
        part = order[k : k + max(1, (1 << 18) // width)]
        k += len(part)
        at = lo[part, None] + np.arange(width)
        cell = buckets.take(at, mode="clip")  # flat places: faster than pairs of indices
        cell += owner[part, None] << BITS
        hit = has.take(cell) & (at < hi[part, None])
        part = part[hit.sum(axis=1, dtype=np.int32) >= need[part]]
        yield from zip(*(x[part].tolist() for x in (owner, text, start, lo, hi)), strict=True)


def _places(hits: np.ndarray, need: int, before: int, after: int, n: int) -> np.ndarray:
    """Places p of 0..n-1 with at least ``need`` of the sorted ``hits`` in p - before .. p + after - 1."""
    first, last = hits[: max(0, len(hits) - need + 1)], hits[need - 1 :]
    near = last - first < before + after
    begin, end = np.maximum(last[near] - after + 1, 0), np.minimum(first[near] + before + 1, n)
    begin[1:] = np.maximum(begin[1:], end[:-1])  # each place once; both are sorted
    size = np.maximum(end - begin, 0)
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class Short:
    """An item of few words, searched at every place."""

    def __init__(self, owner: int, item: Item):
        self.owner, self.need, self.words = owner, item.need, np.array(item.words, np.uint64)
        self.margin = max(2, len(item.words) // 4)
        places, self.often = np.unique((self.words >> _SHIFT).astype(np.int64), return_counts=True)
        self.slot = np.full(1 << BITS, len(places))
        self.slot[places] = np.arange(len(places))

    def starts(self, h: np.ndarray, buckets: np.ndarray, cut: np.ndarray, hits: np.ndarray) -> Iterator[tuple]:
        """(item, text, start, lo, hi, words in place) of the places in ``h``
        that could hold the item, none that the verdict would accept left out;
        ``hits`` are the places of words in its buckets."""
        n, m, none = len(self.words), self.margin, len(self.often)
        places = _places(hits, self.need, m, n + m, len(h))
        for k in range(0, len(places), 4096):
            start = places[k : k + 4096]
            text = np.searchsorted(cut, start, side="right") - 1
            at = start[:, None] + np.arange(n)
            fits = (h[np.minimum(at, len(h) - 1)] == self.words) & (at < cut[text + 1][:, None])
            some = fits.any(axis=1)
            start, text, fits = start[some], text[some], fits[some].sum(axis=1)
            lo, hi = np.maximum(cut[text], start - m), np.minimum(cut[text + 1], start + n + m)
            at = lo[:, None] + np.arange(n + 2 * m)
            slot = np.where(at < hi[:, None], self.slot[buckets[np.minimum(at, len(h) - 1)]], none)
            slot += np.arange(len(at))[:, None] * (none + 1)
            count = np.bincount(slot.ravel(), minlength=len(at) * (none + 1)).reshape(-1, none + 1)[:, :none]
            some = np.minimum(count, self.often).sum(axis=1) >= self.need
            found = (x[some].tolist() for x in (text, start, lo, hi, fits))
            yield from ((self.owner, *x) for x in zip(*found, strict=True))


def _hits(short: list[Short], sets: list[np.ndarray], buckets: np.ndarray) -> Iterator[tuple[Short, np.ndarray]]:
    """Each short item with the places of words in its buckets; ``sets`` has the
    buckets' items as bits, by groups of 64 items."""
    for k, bits in enumerate(sets):
        of = bits.take(buckets)
        some = np.flatnonzero(of)
        of = of[some]
        for i, item in enumerate(short[64 * k : 64 * k + 64]):
            yield item, some[(of & np.uint64(1 << i)) != 0]


def _search(bench: Benchmark, space: np.ndarray, min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        has = np.zeros((len(bench.items), 1 << BITS), bool)  # buckets of each item's words
        for i, item in enumerate(bench.items):
            has[i, (np.array(item.words, np.uint64) >> _SHIFT).astype(np.int64)] = True
        short = [Short(i, item) for i, item in enumerate(bench.items) if len(item.words) < SHORT_ITEM]
        sets = [np.zeros(1 << BITS, np.uint64) for _ in range(0, len(short), 64)]
        for i, item in enumerate(short):
            sets[i // 64] |= has[item.owner].astype(np.uint64) << np.uint64(i % 64)
        cosines = np.empty((max(64, CELLS // max(1, len(bench.owner))), len(bench.owner)), np.float32)
        for b in batches:
            doc_ids, rows = column(b, "doc_id").to_pylist(), []
            for begin, texts in chunked(text_bytes(b)):
                h, cut = hasher(texts)
                if not len(h) or not bench.items:
                    continue
                buckets = (h >> _SHIFT).astype(np.int64)
                best: dict[tuple[int, int], tuple] = {}
                for item, hits in _hits(short, sets, buckets):
                    for owner, text, start, lo, hi, fits in item.starts(h, buckets, cut, hits):
                        share, answer, leak = judge(h[lo:hi].tolist(), bench.items[owner])
                        row = (share, answer, fits, int(cut[text]) - start)
                        if leak and row > best.get((text, owner), (0,)):
                            best[text, owner] = row
                best = {pair: (share, answer, at) for pair, (share, answer, _, at) in best.items()}
                at, first, end = passages(h, cut) if len(bench.owner) else (cut[:0],) * 3
                narrow = buckets.astype(np.int32)
                for k in range(0, len(at), COMPARED):
                    part = slice(k, k + COMPARED)
                    folded = _fold(space, _rows(narrow, first[part], end[part]))
                    p, q = _near(folded, bench.queries, min_cosine, cosines)
                    text = np.searchsorted(cut, at[part][p], side="right") - 1
                    found = np.stack([bench.owner[q], text, at[part][p] - bench.anchor[q]], axis=1)
                    for owner, text, start, lo, hi in _regions(bench, has, buckets, cut, found):
                        share, answer, leak = judge(h[lo:hi].tolist(), bench.items[owner])
                        row = (share, answer, -(max(start, int(cut[text])) - int(cut[text])))
                        if leak and row > best.get((text, owner), (0,)):
                            best[text, owner] = row
                rows += [(doc_ids[begin + t], bench.items[o].item_id, s, a, -w) for (t, o), (s, a, w) in sorted(best.items())]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "item_id", "lcs_share", "answer_found", "at_word"]
            )

    return run


def leaks(docs: DataFrame, bench: DataFrame, min_cosine: float = MIN_COSINE, fit_docs: int | None = None) -> DataFrame:
    """doc_id, item_id, lcs_share, answer_found, at_word: one row per document
    and benchmark item that it holds."""
    spark = docs.sparkSession
    small_batches(spark)
    items = bench.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).where("text IS NOT NULL")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    space = latent_space(rows, items, fit_docs)
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for k in range(blocks):
        block = prepare([tuple(r) for r in items.where(number == k).orderBy("item_id", "text").collect()], space)
        part = rows.mapInArrow(
            _search(block, space, min_cosine), "doc_id long, item_id long, lcs_share double, answer_found boolean, at_word long"
        )
        out = part if out is None else out.union(part)
    best = F.max(F.struct("lcs_share", "answer_found", -F.col("at_word")))
    grouped = out.groupBy("doc_id", "item_id").agg(best.alias("_b"))
    return grouped.select("doc_id", "item_id", "_b.lcs_share", "_b.answer_found", (-F.col("_b")["col3"]).alias("at_word"))


def q_decontaminate(spark, sf_dir: str) -> DataFrame:
    """op1: documents that hold benchmark items, by pairs."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
