"""Conversation repair against a plain cheapest-first search over whole conversations."""

import hashlib
import heapq
import itertools
import random

import pytest

from airshed.llm import conversation_repair as cr

from .helpers import SPACES, same, with_clashes

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """(role, text) of one conversation's (turn, role, text) rows, nulls as one space."""
    told = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()
    told.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), digest(z[1], z[2])))
    return [(r, x) for _, r, x in told]


def faults(turns):
    out = []
    for i, (role, text) in enumerate(turns):
        solid = text.rstrip(SPACES)
        out.append("blank" if not solid else "duplicate" if (role, text) in turns[:i] else "" if solid[-1] in ".!?" else "truncated")
    return out


def cheapest(turns):
    """(cost, audit, repaired turns): uniform-cost search over all edits."""
    found = faults(turns)
    count = itertools.count()
    heap = [(0, "", next(count), 0, ())]
    done = set()
    while heap:
        cost, audit, _, i, kept = heapq.heappop(heap)
        letters = "".join(role[:1] for role, _ in kept)
        body = letters[1:] if letters[:1] == "s" else letters
        state = (i, letters[:1] == "s" and not body, body[-1:], bool(kept))
        if state in done:
            continue
        done.add(state)
        if i == len(turns) and (not kept or body.endswith("a")):
            return cost, audit, list(kept)
        due = "assistant" if body.endswith("u") else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", next(count), i, (*kept, (due, ""))))
        if i == len(turns):
            continue
        role, text = turns[i]
        heapq.heappush(heap, (cost + 2, audit + "D", next(count), i + 1, kept))
        if found[i] not in ("blank", "duplicate"):
            stays = 5 * (found[i] == "truncated")
            if role[:1] == due[0] or (role[:1] == "s" and not kept):
                heapq.heappush(heap, (cost + stays, audit + "K", next(count), i + 1, (*kept, (role, text))))
            heapq.heappush(heap, (cost + stays + 1, audit + "R", next(count), i + 1, (*kept, (due, text))))


def expected(conv, rows):
    turns = ordered(rows)
    found = faults(turns)
    cost, audit, kept = cheapest(turns)
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in itertools.pairwise(turns)]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(not (a[:1] and b[:1] and p in ("su", "ua", "au")) for p, ((a, _), (b, _)) in zip(pairs, itertools.pairwise(turns)))
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
    return (conv, gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def conversations(seed=3, n=120):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ustedes"]
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Why?", "Who? ", "x.\r\n", "a:b\nc."]
    out = {}
    for conv in range(n):
        size = rng.choice([1, 2, 3, 5, 8, 13, 21])
        rows = [(rng.choice([k, k, k, k, None, 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"Turn {k}.") for k in range(size)]
        out[conv if conv else None] = rows
    return out


@pytest.mark.parametrize("segment", [cr.SEGMENT, 1, 3])
def test_audit_equals_search_over_whole_conversations(spark, segment):
    convs = conversations()
    frame = spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in cr.audit(with_clashes(frame), segment).collect()]
    same(got, [expected(c, rows) for c, rows in convs.items()])


def test_repaired_turns_follow_the_pattern(spark):
    convs = conversations(seed=4, n=40)
    frame = spark.createDataFrame([(c, *r) for c, rows in convs.items() for r in rows], SCHEMA)
    got = [(r["conv_id"], r["pos"], r["role"], r["text"]) for r in cr.repair(frame, 4).collect()]
    want = [(c, k, *turn) for c, rows in convs.items() for k, turn in enumerate(cheapest(ordered(rows))[2])]
    same(got, want)


def test_search_is_exact_from_every_state_and_end():
    rng = random.Random(1)
    for _ in range(200):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(0, 4)))
        end = [rng.choice([0, 1, 5, 10, cr.FAR]) for _ in range(4)]
        for state in range(4):
            best = {}
            todo = [(0, state, 0, "")]
            while todo:
                i, at, cost, audit = todo.pop()
                if i == len(codes) and end[at] < cr.FAR:
                    best[cost + end[at], audit] = (cost, audit, at)
                if i < len(codes):  # inserts after the last row are the next segment's
                    if not audit.endswith("III"):
                        todo.append((i, cr.NEXT[at], cost + 5, audit + "I"))
                    todo += [(i + 1, to, cost + price, audit + name) for name, price, to in cr.MOVES[codes[i]][at]]
            got = cr.search(codes, state, end)
            assert (tuple(got) if got else None) == (best[min(best)] if best else None)


def test_long_conversation_in_segments(spark):
    """One conversation holds nearly all rows; its segments give the whole's repair."""
    rng = random.Random(9)
    rows = [(k, rng.choice(["user", "assistant"]), f"Turn {k}" + rng.choice(["", ".", ".", "."])) for k in range(3000)]
    frame = spark.createDataFrame([(7, *r) for r in rows] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yes.")], SCHEMA)
    got = {r["conv_id"]: tuple(r) for r in cr.audit(frame, 64).collect()}
    assert got == {7: expected(7, rows), 8: expected(8, [(0, "user", "Hi."), (1, "assistant", "Yes.")])}


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert cr.audit(frame).count() == 0 and cr.repair(frame).count() == 0


def test_query_keeps_conversations_without_rows(spark, tmpdir_path):
    """Rows dealt 0 by the damage go; their conversation stays, with zeros."""
    import zlib

    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in cr.q_conversation_repair(spark, tmpdir_path).collect()}
    assert set(got) == {gone, None}
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
