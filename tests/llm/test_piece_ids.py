"""Ids of texts by pieces against the library's own encoding of whole texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from airshed.llm import piece_ids, token_ids

PARTS = [
    " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x7f", "\x00", "\x85", "\xa0", " ", " ", " ", " ", " ",
    "　", "​", "﻿", "́", "¿", "é", "ÿ", "日本", "\U0001f600", "a", "the", "Hello", "1", "23", "'s", "'ll",
    "!", "...", "<|endoftext|>", "<|endof", "text|>", "x" * 20,
]


class Spy:
    """A tokenizer that counts the characters it is asked to encode."""

    def __init__(self):
        self.tokenizer, self.seen = token_ids.load_tokenizer(token_ids.TOKENIZER), 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.tokenizer.encode_batch(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.fixture(scope="module")
def tokenizer():
    return token_ids.load_tokenizer(token_ids.TOKENIZER)


@pytest.mark.parametrize("slot_bits", [2, 16])
def test_pieces_give_the_ids_of_whole_texts(tokenizer, slot_bits, monkeypatch):
    monkeypatch.setattr(piece_ids, "SLOT_BITS", slot_bits)
    encoder, rng = piece_ids.PieceIds(tokenizer), random.Random(slot_bits)
    assert encoder.by_pieces
    for _ in range(40):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(30)] + ["", " ", "\n\n", "word"]
        want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in encoder([t.encode() for t in texts])] == want
    assert encoder([]) == []


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import AddedToken, Tokenizer, models, pre_tokenizers

    def plain():
        made = Tokenizer(models.BPE({"a": 0, "b": 1, "Ġ": 2, "ab": 3}, [("a", "b")]))
        made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        return made

    assert piece_ids.splits_at_space(plain())
    glued = plain()
    glued.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    spaced = plain()
    spaced.add_tokens([AddedToken("a b", normalized=False)])
    for other in (glued, spaced):
        assert not piece_ids.splits_at_space(other)
        got = piece_ids.PieceIds(other)([b"ab ab a b", b""])
        assert [x.tolist() for x in got] == [x.ids for x in other.encode_batch(["ab ab a b", ""], add_special_tokens=False)]


def test_known_pieces_are_not_encoded_again(monkeypatch):
    """The library's share of the CPU time: it took every text in full before."""
    spy = Spy()
    monkeypatch.setattr(token_ids, "load_tokenizer", lambda name: spy)
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(40)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([i]), pa.array([t])], names=["shard", "doc_id", "text"])
        for i, t in enumerate(texts)
    ]
    rows = list(token_ids._write_segments("spy")(iter(batches)))
    want = [[*spy.tokenizer.encode(t, add_special_tokens=False).ids, token_ids.END_ID] for t in texts]
    got = token_ids.range_coder.decode(rows[0].column(5)[0].as_py())
    assert np.array_equal(got, np.concatenate(want))
    assert spy.seen < sum(map(len, texts)) / 5
