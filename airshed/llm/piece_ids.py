"""Token ids of whole texts, each piece between white space encoded once.

A byte-level BPE splits a text by a regular expression before anything else, and
none of the parts goes on from a non-space character into white space, nor does
what follows depend on what came before. So the ids of a text are those of its
pieces in a row, where a piece begins with white space after a non-space
character. ``PieceIds`` keeps the ids of short pieces in a table of fixed size (a
later piece takes the place of an earlier one in its slot) and looks up all pieces
of a batch in a few numpy passes, by their own bytes; the tokenizer encodes all
others. Nothing is kept of tokenizers for which the above does not hold: these
encode every text in one go (``splits_at_space``).
"""

from __future__ import annotations

import json

import numpy as np

from airshed.llm.common import SPACE_BYTES, chunked

SLOT_BITS = 22
KEY_BYTES, KEPT_IDS = 15, 8  # of a piece that is kept, at most
_COUNT = np.uint64(0xF0 << 56)  # a slot: 15 bytes of key, length and number of ids; 8 ids
_PLACES = np.arange(KEPT_IDS) < np.arange(KEPT_IDS + 1)[:, None]
_FULL = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def splits_at_space(tokenizer) -> bool:
    """Is it a plain byte-level BPE, whose pieces are encoded independently?"""
    made = json.loads(tokenizer.to_str())
    before, model = made["pre_tokenizer"] or {}, made["model"]
    if any(made[k] is not None for k in ("truncation", "padding", "normalizer", "post_processor")):
        return False
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
        return False
    if model["type"] != "BPE" or model["dropout"] is not None:
        return False
    whole = ("single_word", "lstrip", "rstrip", "normalized")
    return not any(any(t[k] for k in whole) or any(c.isspace() for c in t["content"]) for t in made["added_tokens"])


def piece_starts(buf: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces begin: at the texts' own beginnings, and at ASCII white space
    after a character that is surely none. A last byte of U+0085 to U+00BF or of a
    character led by E1 to E3 may be of white space: no piece begins after these."""
    first = np.zeros(len(buf) + 1, bool)
    at = np.flatnonzero((buf == 32) | (buf - np.uint8(9) < 5))  # bytes wrap around
    one = buf[at - 1]
    wide = one >= 0x80
    sure = (one > 32) & (one != 127)
    if wide.any():
        two, three = buf[at - 2], buf[at - 3]
        sure &= ~(wide & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))
    first[at[sure]] = True
    first[texts] = True
    return np.flatnonzero(first[:-1])


def token_sizes(tokenizer) -> np.ndarray:
    """Bytes of text that each id stands for: a character of a byte-level token
    is a byte, added tokens are plain text."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    added = {i: len(t.content.encode()) for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = np.zeros(1 + max([*vocabulary.values(), *added], default=0), np.int64)
    for token, i in vocabulary.items():
        out[i] = len(token)
    for i, n in added.items():
        out[i] = n
    return out


class PieceIds:
    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.by_pieces = splits_at_space(tokenizer)
        if self.by_pieces:
            self.slots = np.zeros((1 << SLOT_BITS, 4), np.uint64)
            self.sizes = token_sizes(tokenizer)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.uint16) for x in encoded]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text (UTF-8)."""
        if not self.by_pieces:
            return self._encode(texts)
        return [ids for _, part in chunked(texts) for ids in self._texts(part)]

    def _texts(self, texts: list[bytes]) -> list[np.ndarray]:
        data = b"".join(texts) + bytes(KEY_BYTES + 1)
        buf = np.frombuffer(data, np.uint8)
        begin = np.cumsum([0, *map(len, texts)])
        start = piece_starts(buf[: begin[-1]], begin[:-1])
        count, ids = self._pieces(data, buf, start, np.append(start[1:], begin[-1]))
        cut = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(start, begin)]
        return [ids[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def _pieces(self, data: bytes, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids)."""
        size = end - start
        key = np.ndarray((len(buf) - KEY_BYTES,), f"V{KEY_BYTES + 1}", data, 0, (1,))[start].view("<u8").reshape(-1, 2)
        key[:, 0] &= _FULL.take(size, mode="clip")
        key[:, 1] &= _FULL.take(np.clip(size - 8, 0, 7))
        key[:, 1] |= size.astype(np.uint64) << np.uint64(56)
        mixed = (key[:, 0] ^ key[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        slot = (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        kept = self.slots.take(slot, axis=0, mode="clip")
        hit = (kept[:, 0] == key[:, 0]) & ((kept[:, 1] & ~_COUNT) == key[:, 1]) & (size <= KEY_BYTES)
        count = (kept[:, 1] >> np.uint64(60)).astype(np.int64)
        known = np.compress(_PLACES.take(count * hit, axis=0).ravel(), kept[:, 2:].copy().view("<u2").ravel())
        miss = np.flatnonzero(~hit)
        if not len(miss):
            return count, known
        pieces = [data[s:e] for s, e in zip(start[miss].tolist(), end[miss].tolist(), strict=True)]
        once = list(dict.fromkeys(pieces))
        number, first, flat = self._new(once)
        index = dict(zip(once, range(len(once)), strict=True))
        which = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
        count[miss] = number[which]
        at_known = np.repeat(hit, count)
        ids = np.empty(len(at_known), np.uint16)
        ids[at_known] = known
        before = np.cumsum(count[miss]) - count[miss]
        ids[~at_known] = flat[np.repeat(first[which] - before, count[miss]) + np.arange(len(ids) - len(known))]
        keep = (count[miss] <= KEPT_IDS) & (size[miss] <= KEY_BYTES)
        miss, which = miss[keep], which[keep]
        row = np.zeros((len(miss), 4), np.uint64)
        row[:, :2] = key[miss]
        row[:, 1] |= number[which].astype(np.uint64) << np.uint64(60)
        place = first[which, None] + np.arange(KEPT_IDS)
        row[:, 2:] = (flat.take(place, mode="clip") * _PLACES[number[which]]).astype("<u2").view(np.uint64)
        self.slots[slot[miss]] = row
        return count, ids

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids of each piece, place of its first, all ids). Pieces that
        begin with white space and end without are encoded in a row, as in a text."""
        alone = [not (p[0] in SPACE_BYTES and 32 < p[-1] < 127) for p in pieces]
        row = [p for p, a in zip(pieces, alone, strict=True) if not a]
        single = [p for p, a in zip(pieces, alone, strict=True) if a]
        whole, *rest = self._encode([b"".join(row), *single])
        ends = np.cumsum(self.sizes[whole])
        bound = np.cumsum([0, *map(len, row)])
        cut = np.searchsorted(ends, bound[1:], side="right")
        if bound[-1] != (ends[-1] if len(ends) else 0) or (ends[cut - 1] != bound[1:]).any():
            raise ValueError("the tokenizer's ids do not give the text's length")
        number = np.zeros(len(pieces), np.int64)
        is_alone = np.array(alone, bool)
        number[~is_alone] = np.diff(cut, prepend=0)
        number[is_alone] = list(map(len, rest))
        first = np.zeros(len(pieces), np.int64)
        first[~is_alone] = cut - number[~is_alone]
        first[is_alone] = len(whole) + np.cumsum(number[is_alone]) - number[is_alone]
        return number, first, np.concatenate([whole, *rest])
