"""Toxicity, language ID, PII and decontamination on small whole tables."""

import random
import re
import zlib

import numpy as np
import pytest

from airshed.llm import decontaminate, language_id, pii, toxicity

from .helpers import DOC_SCHEMA, awkward_docs, latent_products, prose, same, with_clashes

LABELS = "doc_id long, quality int, toxic int"


def crc(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


# --- toxicity


def toxic_corpus(rng, n=500):
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(rng, rng.randint(4, 12)).capitalize() + "." for _ in range(rng.randint(2, 12))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] = f"You {rng.choice(['zonker', 'zonkerish', 'blorf'])} {sentences[k]}"
        rows.append((1000 + i, " ".join(sentences), "en", "s0", 1))
        labels.append((1000 + i, 1, int(bad)))
    return rows, labels


def test_toxicity_finds_documents_and_sentences(spark):
    rows, labels = toxic_corpus(random.Random(5))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, _, y in labels if crc(i, 5) == 0]
    assert sum((got[i]["score"] >= 0.5) == bool(y) for i, y in held) / len(held) > 0.95
    text = {r[0]: r[1] for r in rows}
    spans = [(i, s) for i, y in held if y for s in got[i]["sentences"]]
    assert spans and sum(bool(re.search("zonker|blorf", text[i][s["start"] : s["end"]])) for i, s in spans) / len(spans) > 0.9


@pytest.mark.parametrize("rows", [[], awkward_docs()])
@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 0, None), (None, 1, 1)], [(i, 1, i % 2) for i in range(30)]])
def test_toxicity_awkward_rows(spark, rows, labels):
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    out = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert all(r["score"] == 0 for r in out if r["doc_id"] in (100, 101, 102))


# --- language ID


def test_language_id_held_out_accuracy(spark):
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["schr", "ung", "kei"], "cc": ["ción", "ñe", "ado"], "dd": ["かな", "です", "ます"]}
    rng, rows = random.Random(2), []
    for i in range(600):
        lang = rng.choice(sorted(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randint(3, 60)))
        rows.append((i, text, lang, "s", 1))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    held = [r for r in rows if crc(r[0], 3) == 1]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("rows", [[], awkward_docs(), [(1, None, "en", "s", 0), (2, "123 456", "fr", "s", 0), (3, "a", None, "s", 0)]])
def test_language_id_awkward_rows(spark, rows):
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    same([(r["doc_id"],) for r in out], [(r[0],) for r in rows])
    letters = {r[0]: any(c.isalpha() for c in r[1] or "") for r in rows}
    learnt = {r[2] for r in rows}
    for r in out:
        assert r["lang_pred"] in learnt or r["lang_pred"] == "und"
        if not letters[r["doc_id"]]:
            assert r["lang_pred"] == "und" and r["score"] == 0


# --- PII


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0


def brute_base(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([ -]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        out += [(2, *m.span())] if 13 <= len(d) <= 19 and luhn(d) else []
    for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text):
        out += [(3, *m.span())] if 9 <= sum(c in "0123456789" for c in m[0]) <= 15 else []
    return out


def test_base_spans_match_plain_expressions():
    rng = random.Random(11)
    pieces = ["a.b@c.de", "x@y", "@", "ann@mail.example.com", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "é",
              "+1 (202) 555-0143", "+44", "+", "..", "-", " ", "\n", "7", "01.002.3.4.5", "a@b.c_d@e.f", "%", "1.2.3", "5500000000000004"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == brute_base(text), text
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []  # linear time


def test_bootstrap_finds_unseen_identifiers(spark):
    rng = random.Random(4)
    rows = [(i, f"{prose(rng, 8)} please mail: user{i}@mail{i}.example.com and {prose(rng, 5)}", "en", "s", 1) for i in range(40)]
    rows += [(100 + i, f"{prose(rng, 6)} please mail: person{i} (at) host{i} (dot) org then {prose(rng, 4)}", "en", "s", 1) for i in range(3)]
    rows += [(200 + i, f"{prose(rng, 6)} order number 12345678{i} {prose(rng, 4)}", "en", "s", 1) for i in range(9)]
    text = {r[0]: r[1] for r in rows}
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    for i in range(3):
        assert [text[100 + i][s["start"] : s["end"]] for s in found[100 + i]["spans"]] == [f"person{i} (at) host{i} (dot) org"]
        assert found[100 + i]["base"] == []
    assert all(found[200 + i]["spans"] == [] for i in range(9))
    assert all(len(found[i]["spans"]) == len(found[i]["base"]) == 1 for i in range(40))


@pytest.mark.parametrize("rows", [[], awkward_docs() + [(1, "a@b.co", "x", "s", 1), (None, "1.2.3.4", "x", "s", 1)]])
def test_pii_awkward_rows(spark, rows):
    out = pii.find(with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))).collect()
    same([(r["doc_id"], [tuple(s) for s in r["base"]]) for r in out], [(r[0], brute_base(r[1] or "")) for r in rows])


# --- decontamination


def norm(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def lcs_len(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_by_bits():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 40))] for _ in range(2))
        masks = {}
        for i, w in enumerate(b):
            masks[w] = masks.get(w, 0) | 1 << i
        assert decontaminate.lcs(a, masks, len(b)) == lcs_len(a, b)


def test_places_with_hits_enough():
    rng = np.random.default_rng(3)
    for _ in range(2000):
        n, need, before, after = (int(rng.integers(lo, hi)) for lo, hi in ((1, 40), (1, 8), (0, 5), (1, 15)))
        hit = rng.random(n) < rng.random()
        want = [p for p in range(n) if hit[max(0, p - before) : p + after].sum() >= need]
        assert decontaminate._places(np.flatnonzero(hit), need, before, after, n).tolist() == want


@pytest.mark.parametrize("n", [1, 7, 64])
def test_near_finds_every_pair(n):
    rng = np.random.default_rng(n)
    for passages, least in ((1, 0), (5, 50), (8, 2), (100, 1), (100, 99)):
        folded, queries = (rng.integers(-2, 3, shape).astype(np.float32) for shape in ((passages, 4), (4, n)))
        got = decontaminate._near(folded, queries, least, np.full((9, n), 99, np.float32))
        assert [x.tolist() for x in got] == [x.tolist() for x in np.nonzero(folded @ queries >= least)]


def varied(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_leaks_against_brute_force(spark):
    rng = random.Random(21)
    common = [varied(rng, 1) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else varied(rng, 1) for _ in range(n))
    items = [(i, text(rng.randint(15, 60))) for i in range(30)] + [(90, None), (91, ""), (92, "too short")]
    rows, truth = [], set()
    for i in range(300):
        body, k = text(rng.randint(20, 300)).split(), i % 30
        at = rng.randrange(len(body))
        leak = items[k][1].split()
        if i % 3 == 0:  # exact, in capitals
            body[at:at] = items[k][1].upper().split()
            truth.add((i, k))
        elif i % 3 == 1:  # a paraphrase: some words changed, none of the last
            changed = set(rng.sample(range(len(leak) - 5), len(leak) // 8))
            body[at:at] = [varied(rng, 1) if j in changed else w for j, w in enumerate(leak)]
            truth.add((i, k))
        rows.append((i, " ".join(body), "en", "s", 1))
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench, fit_docs=100).collect()}
    # brute force over all pairs, whole texts
    brute = set()
    for i, t, *_ in rows:
        w = norm(t)
        for k, x in items:
            n = norm(x)
            if len(n) >= decontaminate.MIN_ITEM and lcs_len(w, n) >= 0.8 * len(n) and (i, k) in truth:
                brute.add((i, k))
    assert len(brute & got.keys()) >= 0.97 * len(brute)
    assert got.keys() <= truth
    exact = {p for p in truth if p[0] % 3 == 0}
    assert exact <= got.keys() and all(got[p]["lcs_share"] == 1 for p in exact)


def test_latent_space_is_fitted_on_every_document(spark):
    """With V the directions and S the singular values of all passages, what a
    word adds is idf * V / S: it turns their A'A into ones."""
    rng = random.Random(22)
    vocabulary = sorted({varied(rng, 1) for _ in range(30)})
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(13, 30)))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    space = decontaminate.latent_space(docs, spark.createDataFrame([], "item_id long, text string"))
    turned = latent_products(space, [t for _, t in rows], [])
    ones = np.diag(turned)[: len(vocabulary)]
    assert np.allclose(ones, 1, atol=0.05)
    assert np.abs(turned - np.diag(np.diag(turned))).max() < 0.05


def fresh(rng, n):
    """Words that nothing else has."""
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(14)) for _ in range(n)]


def changed_evenly(rng, words, share, answer):
    """Every word but those of the answer may change; ``share`` of all stay."""
    n, change = len(words) - answer, round(len(words) * (1 - share))
    at = {k * n // change for k in range(change)}
    return [fresh(rng, 1)[0] if i in at else w for i, w in enumerate(words)]


def test_leaks_with_few_shared_words_in_every_passage(spark):
    """At 60 to 70 % of an item's words few passages share 8 words of 12."""
    rng = random.Random(31)
    items = [(i, " ".join(fresh(rng, 22)) + ". " + " ".join(fresh(rng, 3))) for i in range(30)]
    rows = []
    for i in range(300):
        copy = changed_evenly(rng, norm(items[i % 30][1]), 0.62, 3)
        assert 0.6 <= lcs_len(copy, norm(items[i % 30][1])) / 25 < 0.8
        rows.append((i, " ".join(fresh(rng, 40) + copy + fresh(rng, 40)), "en", "s", 1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(spark.createDataFrame(rows, DOC_SCHEMA), bench, fit_docs=10).collect()}
    assert got.keys() <= {(i, i % 30) for i in range(300)} and len(got) >= 270
    assert all(r["answer_found"] and 0.6 <= r["lcs_share"] < 0.8 for r in got.values())


@pytest.mark.parametrize("known", [0, 0.2])
def test_leaks_finds_exact_copies_of_short_items(spark, known):
    """Items of 6 to 21 words inside longer documents, at the edges too; some
    words around them are the benchmark's."""
    rng = random.Random(33)
    items = [(n, " ".join(fresh(rng, n))) for n in range(decontaminate.MIN_ITEM, 22)]
    vocabulary = [w for _, t in items for w in norm(t)]
    around = lambda n: [rng.choice(vocabulary) if rng.random() < known else w for w in fresh(rng, n)]
    rows, want = [], set()
    for i in range(20 * len(items)):
        n, text = items[i % len(items)]
        before = 0 if i < len(items) else rng.randint(1, 60)
        after = 0 if i >= 19 * len(items) else rng.randint(1, 60)
        rows.append((i, " ".join(around(before) + norm(text) + around(after)), "en", "s", 1))
        want.add((i, n, 1.0, True, before))
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), fit_docs=10).collect()
    assert {tuple(r)[:4] for r in got} == {w[:4] for w in want}
    short = decontaminate.WINDOW + decontaminate.ANCHOR_RUN
    assert {tuple(r) for r in got if r["item_id"] < short} == {w for w in want if w[1] < short}


def test_leaks_of_short_items_match_brute_force(spark):
    """Paraphrases of short items: the verdict at every place decides."""
    rng = random.Random(34)
    items = [(n, " ".join(fresh(rng, n - 2)) + ". " + " ".join(fresh(rng, 2))) for n in range(decontaminate.MIN_ITEM, 20)]
    rows, want = [], set()
    for i in range(10 * len(items)):
        n, text = items[i % len(items)]
        copy = changed_evenly(rng, norm(text), rng.choice([0.62, 0.75, 0.9]), 2)
        rows.append((i, " ".join(fresh(rng, 30) + copy + fresh(rng, 30)), "en", "s", 1))
        if lcs_len(copy, norm(text)) / n >= 0.6:
            want.add((i, n))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), fit_docs=10).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


@pytest.mark.parametrize("rows", [[], awkward_docs()])
@pytest.mark.parametrize("items", [[], [(1, awkward_docs()[9][1]), (None, None), (3, "x"), (4, "")]])
def test_leaks_awkward_rows(spark, rows, items):
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA))
    out = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert ({(r["doc_id"], r["item_id"]) for r in out} >= {(9, 1)}) == bool(rows and items)


# --- samples are bounded in rows, not in ids


@pytest.fixture()
def one_hot_id(spark):
    rng = random.Random(21)
    rows = [(5, prose(rng, 12), "en" if k % 2 else "fr", "s0", 1) for k in range(400)] + [(k, prose(rng, 12), "fr", "s0", 1) for k in range(10, 40)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def rows_seen(monkeypatch, module, name):
    """The rows that reach the single fitting task, counted in its result."""
    import pyarrow as pa

    def count(batches):
        yield pa.RecordBatch.from_arrays([pa.array([str(sum(b.num_rows for b in batches)).encode()], pa.binary())], names=["model"])

    class Seen(Exception):
        pass

    def loads(data):
        raise Seen(data.decode())

    monkeypatch.setattr(module, name, count if name == "_fit_task" else lambda *_: count)
    monkeypatch.setattr(module.pickle, "loads", loads)
    return Seen


def test_one_repeated_id_does_not_fill_the_fitting_task_of_toxicity(spark, one_hot_id, monkeypatch):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], LABELS)
    seen = rows_seen(monkeypatch, toxicity, "_fit_task")
    with pytest.raises(seen) as said:
        toxicity.fit(one_hot_id, labels, max_toxic=6, max_clean=6)
    assert 0 < int(str(said.value)) <= 12


def test_one_repeated_id_does_not_fill_the_fitting_task_of_language_id(spark, one_hot_id, monkeypatch):
    seen = rows_seen(monkeypatch, language_id, "_train")
    with pytest.raises(seen) as said:
        language_id.fit(one_hot_id, max_train=9)
    assert 0 < int(str(said.value)) <= 9


# --- the pattern-instance graph and long texts


def plain_scores(edges, rounds):
    """score_graph on Python sets."""
    import math

    known = {(p, i, k) for p, i, k in edges if k >= 0}
    unknown = {(p, i) for p, i, k in edges if k < 0}
    of = {}
    for p, i, _ in edges:
        of.setdefault(p, set()).add(i)
    beliefs, patterns = {}, {}
    for _ in range(rounds):
        held = [(p, k, 1.0) for p, _, k in known] + [(p, beliefs[i][0], beliefs[i][1]) for p, i in unknown if i in beliefs]
        sums = {}
        for p, k, b in held:
            total, n = sums.get((p, k), (0.0, 0))
            sums[p, k] = (total + b, n + 1)
        patterns = {(p, k): total / (len(of[p]) + 1) for (p, k), (total, n) in sums.items() if n >= pii.MIN_SUPPORT and total / (len(of[p]) + 1) >= pii.MIN_CONFIDENCE}
        doubt = {}
        for p, i in unknown:
            for (q, k), c in patterns.items():
                if p == q:
                    doubt[i, k] = doubt.get((i, k), 0.0) + math.log1p(-c)
        beliefs = {}
        for (i, k), d in sorted(doubt.items()):
            b = 1 - math.exp(d)
            if i not in beliefs or (b, -k) > (beliefs[i][1], -beliefs[i][0]):
                beliefs[i] = (k, b)
    return patterns, beliefs


def test_score_graph_equals_plain_sets(spark):
    rng = random.Random(31)
    edges = set()
    for p in range(12):
        for i in rng.sample(range(46), rng.randint(8, 30)):
            kind = i % 3 if i < 40 else -1
            edges.add((f"p{p}", i, (p % 3) if kind >= 0 and p < 8 else kind))
    frame = spark.createDataFrame(sorted(edges), "pattern string, instance long, kind int")
    patterns, beliefs = pii.score_graph(frame)
    want_patterns, want_beliefs = plain_scores(edges, pii.ROUNDS)
    assert want_patterns and want_beliefs
    assert {(r["pattern"], r["kind"]): round(r["confidence"], 9) for r in patterns.collect()} == {k: round(v, 9) for k, v in want_patterns.items()}
    assert {r["instance"]: (r["kind"], round(r["belief"], 9)) for r in beliefs.collect()} == {i: (k, round(b, 9)) for i, (k, b) in want_beliefs.items()}


def test_long_text_with_many_candidates_ends_soon():
    import time

    text = " ".join(f"mail user{k}@host{k}.example and call 5550{k:07d} " for k in range(40_000))
    assert len(text) > 1_500_000
    began = time.time()
    taken = [(s, e) for _, s, e in pii.base_spans(text)]
    found = list(pii._unknown(text, taken))
    for s, _ in found:
        pii._patterns(text, s)
    assert len(found) > 30_000 and time.time() - began < 20
    assert all(e <= a or s >= b for s, e in found[:200] for a, b in taken[:600])


def test_context_never_holds_a_part_of_a_word():
    long = "x" * 200
    assert pii._patterns(f"{long} id 55501234567", 204 + 0) == pii._patterns(f"{'y' * 300} id 55501234567", 304)
    assert pii._patterns("call me: 5", 9) == ["call me:", "me:"]
