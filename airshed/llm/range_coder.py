"""Adaptive context-mixing range coder for token ids.

A segment is a run of ids with one order-0 table; its blocks of BLOCK ids are
coded independently, from the same reset state, and each has a checksum. The
numpy code works on many blocks side by side (a lane each), one id per step.

Model of a lane: an order-1 and an order-2 table predict the next id from a
hash of the last one or two, each with a confidence of 0 to 3. Which of the
predictions comes true is coded with adaptive probabilities, one set per pair
of confidences, so the mix follows how well each order does. An id that neither
predicts is coded by the order-0 distribution.

The coder keeps 64 bits of low and range and moves a 32-bit word whenever the
range is below 2**32; where a carry could still come, the range is cut instead.

Layout (little-endian): magic, ids in the segment, blocks, symbols of the
order-0 table and its zlib bytes; the blocks' crc32s, their numbers of 32-bit
words, all words. Ids must be below 2**16.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDRC"
BLOCK = 4096
LANES = 2048
TABLE_BITS = 12
_TOTAL_BITS = 16
_TOTAL = 1 << _TOTAL_BITS
_LEAST = 64  # of _TOTAL, for a prediction to come true or not
_RATE_BITS = 4
_U = np.uint64
_WORD, _LOW = np.array([[32], [(1 << 32) - 1]], _U)
# Operands of the steps, as arrays: numpy takes longer for single numbers.
_HASH = np.array([[0x9E3779B1], [0x85EBCA77]], np.uint32)
_ONE, _TWO, _THREE, _SHIFT, _BITS, _ALL = np.array([[1], [2], [3], [32 - TABLE_BITS], [_TOTAL_BITS], [_TOTAL]], np.uint32)
_RATE = np.array([_RATE_BITS], np.int32)
_BITS_U, _LAST, _ONE_U = np.array([[_TOTAL_BITS], [_TOTAL - 1], [1]], _U)
_TARGET = np.array([_LEAST, _TOTAL - _LEAST], np.int32)


def order0_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids that occur, their frequencies out of _TOTAL, each at least 1)."""
    count = np.bincount(ids, minlength=1)
    symbols = np.flatnonzero(count)
    share = count[symbols] * ((_TOTAL - len(symbols)) / count.sum())
    freq = np.floor(share).astype(np.int64) + 1
    freq[np.argmax(freq)] += _TOTAL - freq.sum()
    return symbols, freq


class _Lanes:
    """The adaptive model of a group of blocks. Of pairs of rows the first is of
    order 1, the second of order 2: one numpy call does both."""

    def __init__(self, n: int):
        lane = np.arange(n)
        self.base = np.stack([lane << TABLE_BITS, lane + n << TABLE_BITS])
        self.table = np.zeros(2 * n << TABLE_BITS, np.uint32)  # id << 2 | confidence
        self.mix = lane << 5
        cells = np.arange(1 << 5)  # confidences of order 2 and 1, is order 1 asked; 0 where nothing is asked for
        self.chance2 = np.tile(np.where(cells >> 3, _TOTAL // 2, 0).astype(np.int32), n)
        self.chance1 = np.tile(np.where(cells & 1, _TOTAL // 2, 0).astype(np.int32), n)
        self.last, self.before = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self._first(n)

    def _first(self, k: int) -> None:
        """From now on only the first k lanes go on. The steps' arrays are kept:
        new ones for each step would not stay in the cache."""
        self.base, self.mix, self.last, self.before = self.base[:, :k].copy(), self.mix[:k], self.last[:k], self.before[:k]
        self.hash, self.entry, self.sure, self.guess, self.less = np.empty((5, 2, k), np.uint32)
        self.at, self.cell = np.empty((2, k), np.intp), np.empty(k, np.intp)
        self.has, self.hit, self.flag = np.empty((3, 2, k), bool)
        self.ask1, self.rest = np.empty((2, k), bool)
        self.state, self.f1, self.fresh = np.empty((3, k), np.uint32)
        self.h2, self.h1, self.step = np.empty((3, k), np.int32)
        self.f2, self.has2 = self.h2.view(np.uint32), self.has[1]
        self.p1, self.p2 = self.guess

    def predict(self, k: int) -> None:
        """Predictions (p1, p2) of the first k lanes, whether they are asked
        for (ask1, has2), and their frequencies (f1, f2)."""
        if k < len(self.mix):
            self._first(k)
        h, state = self.hash, self.state
        np.multiply(self.last, _HASH[0], out=h[0])
        np.bitwise_xor(h[0], self.before, out=h[1])
        np.multiply(h[1], _HASH[1], out=h[1])
        np.right_shift(h, _SHIFT, out=h)
        np.copyto(self.at, h)
        np.add(self.at, self.base, out=self.at)
        self.table.take(self.at, mode="clip", out=self.entry)
        np.bitwise_and(self.entry, _THREE, out=self.sure)
        np.right_shift(self.entry, _TWO, out=self.guess)
        np.copyto(self.has, self.sure, casting="unsafe")
        np.equal(self.p1, self.p2, out=self.rest)
        np.logical_and(self.rest, self.has2, out=self.rest)
        np.greater(self.has[0], self.rest, out=self.ask1)  # there is one, not the same guess again
        np.left_shift(self.sure[1], _TWO, out=state)
        np.bitwise_or(state, self.sure[0], out=state)
        np.left_shift(state, _ONE, out=state)
        np.bitwise_or(state, self.ask1, out=state)
        np.copyto(self.cell, state)
        np.add(self.cell, self.mix, out=self.cell)
        self.chance2.take(self.cell, mode="clip", out=self.h2)
        self.chance1.take(self.cell, mode="clip", out=self.h1)
        np.subtract(_ALL, self.f2, out=self.f1)
        np.multiply(self.f1, self.h1.view(np.uint32), out=self.f1)  # below 2**32
        np.right_shift(self.f1, _BITS, out=self.f1)
        np.maximum(self.f1, self.ask1, out=self.f1)

    def _learn(self, chance: np.ndarray, was: np.ndarray, hit: np.ndarray, asked: np.ndarray) -> None:
        step = self.step
        _TARGET.take(hit.view(np.uint8), mode="clip", out=step)
        np.subtract(step, was, out=step)
        np.right_shift(step, _RATE, out=step)
        np.multiply(step, asked, out=step)
        np.add(step, was, out=step)
        chance[self.cell] = step

    def compare(self, ids: np.ndarray) -> np.ndarray:
        return np.equal(self.guess, ids, out=self.hit)

    def update(self, ids: np.ndarray, is2: np.ndarray) -> None:
        """Learn the ids, compared before; is2: order 2 was asked for and right."""
        self._learn(self.chance2, self.h2, is2, self.has2)
        np.greater(self.ask1, is2, out=self.rest)
        self._learn(self.chance1, self.h1, self.hit[0], self.rest)
        np.left_shift(ids, _TWO, out=self.fresh)
        np.bitwise_or(self.fresh, _ONE, out=self.fresh)
        np.subtract(self.entry, _ONE, out=self.less)
        np.less_equal(self.sure, _ONE, out=self.flag)
        np.copyto(self.less, self.fresh, where=self.flag)
        np.less(self.sure, _THREE, out=self.flag)
        np.add(self.entry, self.flag, out=self.entry)
        np.copyto(self.less, self.entry, where=self.hit)  # an empty entry that "guesses" 0 becomes the fresh one too
        self.table[self.at] = self.less
        self.before, self.last = self.last, ids


def _due(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lanes that must move a word now, their low). Where a carry is still open
    the range is cut at the next multiple of 2**32; it is never empty after that."""
    j = np.flatnonzero(span <= _LOW)
    lo, r = low.take(j, mode="clip"), span.take(j, mode="clip")
    open_carry = (lo ^ (lo + r)) > _LOW
    span[j] = np.where(open_carry, (~lo + _ONE_U) & _LOW, r) << _WORD
    return j, lo


def _encode_lanes(blocks: np.ndarray, lengths: np.ndarray, freq: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    n, steps = blocks.shape
    m = _Lanes(n)
    low, span = np.zeros(n, _U), np.full(n, (1 << 64) - 1, _U)
    width = 2 * steps + 8
    out, pos = np.zeros(n * width, np.uint32), width * np.arange(n)
    columns = np.ascontiguousarray(blocks.T).astype(np.uint32)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # lanes with an id left, longest first
    for t in range(steps):
        k = int(active[t])
        ids = columns[t, :k]
        m.predict(k)
        hit = m.compare(ids)
        is2 = hit[1] & m.has2
        is1 = hit[0] & m.ask1  # not is2: it is not asked for the same guess
        other = ~(is2 | is1)
        lo, r = low[:k], span[:k]
        unit = r >> _BITS_U
        both = m.f2 + m.f1
        begin = np.where(other, both, m.f2)
        begin *= ~is2
        lo += unit * begin.astype(_U)
        size = np.where(is2, m.f2, np.where(is1, m.f1, _ALL - both))
        np.multiply(unit, size.astype(_U), out=r)
        unit = r >> _BITS_U
        place = start.take(ids, mode="clip")
        place *= other
        place *= unit
        lo += place
        unit *= freq.take(ids, mode="clip")
        np.copyto(r, unit, where=other)
        m.update(ids, is2)
        j, moved = _due(lo, r)
        at = pos.take(j, mode="clip")
        out[at] = moved >> _WORD
        pos[j] = at + 1
        lo[j] = moved << _WORD
    for shift in (_WORD, _U(0)):
        out[pos] = (low >> shift) & _LOW
        pos += 1
    return [out[i * width : pos[i]] for i in range(n)]


def _decode_lanes(words: np.ndarray, first: np.ndarray, lengths: np.ndarray, symbols, freq, start, find) -> np.ndarray:
    n, steps = len(lengths), int(lengths.max(initial=0))
    m = _Lanes(n)
    low, span = np.zeros(n, _U), np.full(n, (1 << 64) - 1, _U)
    code = words[first] << _WORD | words[first + 1]
    pos = first + 2
    out = np.zeros((steps, n), np.uint16)
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for t in range(steps):
        k = int(active[t])
        m.predict(k)
        lo, r, c = low[:k], span[:k], code[:k]
        unit = r >> _BITS_U
        two, one = unit * m.f2.astype(_U), unit * m.f1.astype(_U)
        both = two + one
        ahead = c - lo
        is2, other = ahead < two, ahead >= both
        begin = np.where(other, both, two)
        begin *= ~is2
        lo += begin
        ahead -= begin
        unit <<= _BITS_U
        unit -= both
        np.copyto(r, np.where(is2, two, np.where(other, unit, one)))
        unit = r >> _BITS_U  # at least 1: unit was 2**16 or more
        ahead //= unit
        rank = find.take(np.minimum(ahead, _LAST).view(np.int64), mode="clip")
        ids = np.where(other, symbols.take(rank, mode="clip"), np.where(is2, m.p2, m.p1))
        place = start.take(rank, mode="clip")
        place *= other
        place *= unit
        lo += place
        unit *= freq.take(rank, mode="clip")
        np.copyto(r, unit, where=other)
        m.compare(ids)
        m.update(ids, is2)
        j, moved = _due(lo, r)
        at = pos.take(j, mode="clip")
        c[j] = c.take(j, mode="clip") << _WORD | words.take(at, mode="clip")
        pos[j] = at + 1
        lo[j] = moved << _WORD
        out[t, :k] = ids
    return out


def encode(ids: np.ndarray) -> bytes:
    """A segment of ids (unsigned 16 bits) as bytes."""
    ids = np.ascontiguousarray(ids, np.uint16)
    n = len(ids)
    symbols, freq = order0_table(ids) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    start = np.cumsum(freq) - freq
    freq_of, start_of = np.zeros(_TOTAL, _U), np.zeros(_TOTAL, _U)
    freq_of[symbols], start_of[symbols] = freq, start
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u2").tobytes() + (freq - 1).astype("<u2").tobytes(), 6)
    blocks = -(-n // BLOCK)
    padded = np.zeros((blocks, BLOCK), np.uint16)
    padded.ravel()[:n] = ids
    lengths = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    streams: list[np.ndarray] = []
    for k in range(0, blocks, LANES):
        part = slice(k, k + LANES)
        streams += _encode_lanes(padded[part, : lengths[k]], lengths[part], freq_of, start_of)
    crcs = [zlib.crc32(padded[i, : lengths[i]].astype("<u2").tobytes()) for i in range(blocks)]
    head = MAGIC + struct.pack("<QIII", n, blocks, len(symbols), len(table)) + table
    sizes = np.array([len(s) for s in streams], "<u4").tobytes()
    return head + np.array(crcs, "<u4").tobytes() + sizes + b"".join(s.astype("<u4").tobytes() for s in streams)


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if a block is damaged."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of ids")
    n, blocks, n_symbols, table_size = struct.unpack_from("<QIII", data, 4)
    at = 24 + table_size
    table = np.frombuffer(zlib.decompress(data[24:at]), "<u2").astype(np.int64)
    symbols, freq = np.cumsum(table[:n_symbols]), table[n_symbols:] + 1
    start = np.cumsum(freq) - freq
    find = np.repeat(np.arange(n_symbols), freq)
    crcs = np.frombuffer(data, "<u4", blocks, at)
    sizes = np.frombuffer(data, "<u4", blocks, at + 4 * blocks).astype(np.int64)
    words = np.frombuffer(data, "<u4", offset=at + 8 * blocks).astype(_U)
    if len(words) != sizes.sum():
        raise ValueError("a segment is cut off")
    words = np.append(words, np.zeros(8, _U))
    first = np.cumsum(sizes) - sizes
    lengths = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    out = [np.zeros(0, np.uint16)]
    for k in range(0, blocks, LANES):
        part = slice(k, k + LANES)
        ids = _decode_lanes(words, first[part], lengths[part], symbols.astype(np.uint32), freq.astype(_U), start.astype(_U), find)
        for i in range(ids.shape[1]):
            block = ids[: lengths[k + i], i]
            if zlib.crc32(np.ascontiguousarray(block, "<u2").tobytes()) != crcs[k + i]:
                raise ValueError(f"block {k + i} is damaged")
            out.append(block)
    return np.concatenate(out)
