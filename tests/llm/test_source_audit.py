"""Source audit against a plain count over all rows, and the perfect hash alone."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from airshed.llm import source_audit as sa

from .helpers import DOC_SCHEMA, awkward_docs, same, with_clashes

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def expected(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for _, text, lang, source, _ in rows]
    found = defaultdict(Counter)
    for lang, _, used in docs:
        found[lang].update(set(used))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in found.items()}
    groups = {(lang, source): Counter() for lang, source, _ in docs}
    for lang, source, used in docs:
        groups[lang, source].update(t for t in used if found[lang][t] >= min_docs)

    def share(count, lang):
        total = sum(count.values()) + len(kept[lang])
        return {t: 1 + 1_000_000_000 * (count[t] + 1) // total for t in kept[lang]}

    out = []
    for (lang, source), count in groups.items():
        p = share(count, lang)
        value = lambda p, q: (p - q) * (p - q) // q
        pairs = []
        for (other_lang, other), theirs in groups.items():
            if other_lang == lang and other != source:
                q = share(theirs, lang)
                pairs.append((other, sum(value(p[t], q[t]) for t in kept[lang])))
        whole = sum((c for (g, _), c in groups.items() if g == lang), Counter())
        q = share(whole, lang)
        above = [(t, value(p[t], q[t])) for t in kept[lang] if count[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", above, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k + 1) for k, (item, v) in enumerate(items[:most])]
    return out


def corpus(seed=2, n=150):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "Über", "x", "日本", "É") for b in ("", "s", "ing", "ÄÄ", "Z", "q", "a'b", "o_o", "k9k")]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s0"] * 4 + [f"s{k}" for k in range(9)] + [None])
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choices(words[rng.randrange(20) :], k=rng.randrange(60)))
        rows.append((rng.choice([i, None, 5]), text, lang, source, 1))
    return rows + [(900, "only here", "xx", "a", 1), (901, "there", "xx", "b", 1), (902, None, "yy", "a", 1)]


@pytest.mark.parametrize("rows", [corpus(), awkward_docs(), awkward_docs() + corpus(5, 40)])
def test_equals_plain_counts(spark, rows):
    got = sa.audit(with_clashes(spark.createDataFrame(rows, DOC_SCHEMA)))
    same([tuple(r) for r in got.collect()], expected(rows))


def test_small_shards_and_many_rounds_change_nothing(spark):
    rows = corpus(8, 100)
    got = sa.audit(spark.createDataFrame(rows, DOC_SCHEMA).repartition(7), shard_keys=4, round_bytes=2000)
    same([tuple(r) for r in got.collect()], expected(rows))


def test_many_sources_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sa, "SOURCE_BLOCK", 3)
    rows = corpus(4, 120)
    got = sa.audit(spark.createDataFrame(rows, DOC_SCHEMA), min_docs=2, top=3)
    same([tuple(r) for r in got.collect()], expected(rows, 2, 3))


def test_tasks_send_on_what_they_cannot_hold(spark, monkeypatch):
    monkeypatch.setattr(sa, "HELD_TERMS", 5)
    monkeypatch.setattr(sa, "HELD_SLOTS", 10)
    rows = corpus(6, 80)
    same([tuple(r) for r in sa.audit(spark.createDataFrame(rows, DOC_SCHEMA)).collect()], expected(rows))


def test_empty_table(spark):
    assert sa.audit(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20000])
def test_perfect_hash_is_minimal_and_verifies(n):
    keys = [f"k{i}".encode() for i in range(n)]
    index = sa.PerfectHash.loads(sa.PerfectHash(keys).dumps())
    find = lambda ks: index.find(ks, np.fromiter(map(sa.key_hash, ks), np.uint64, len(ks))).tolist()
    assert sorted(find(keys)) == list(range(n))
    assert [index.keys[s] for s in find(keys)] == keys
    assert find([f"other{i}".encode() for i in range(500)]) == [-1] * 500


def test_perfect_hash_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(sa, "key_hash", lambda k: len(k))
    keys = [b"a", b"b", b"cc", b"dd", b"eee"]
    index = sa.PerfectHash(keys)
    slots = index.find([*keys, b"x", b"yyyy"], np.array([1, 1, 2, 2, 3, 1, 4], np.uint64)).tolist()
    assert sorted(slots[:5]) == list(range(5)) and slots[5:] == [-1, -1]


def test_scaled_shares_are_exact():
    rng = random.Random(3)
    counts = [0, 1, *(rng.randrange(10**15) for _ in range(50))]
    for total in (10**15 + 7, 10**15 + 12345):
        got = sa._scaled(np.array(counts, np.int64), total).tolist()
        assert got == [1 + 10**9 * (c + 1) // total for c in counts]
