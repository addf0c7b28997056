"""Conversation structure repair by depth-first branch and bound.

A conversation's rows, ordered by turn, are edited into the roles
``(s?(ua)+)?`` (initials of system, user, assistant) at the least cost. Edits:
Keep (0), Rerole to the role that has to come next (1), Delete (2; required
for blank and duplicate rows) and Insert of an empty turn (5); a truncated row
that stays adds 5. Among the cheapest repairs the one whose audit, the initials
of its edits in order, is ASCII-least is taken.

Method. A node is (row, state of the role pattern); state and edit name the
next state, so an audit is a path. The search keeps an explicit stack, the
incumbent (cost, audit), the least cost of the rest from every node as suffix
bound, and a table of the cost each node was reached at: a prefix is dropped
when its cost plus bound exceeds the incumbent's, when it ties but its audit
is greater, or when its node was reached as cheaply before (children go on the
stack in the order of bound, then audit, so the earlier prefix is the lesser
one). It ends with an empty stack: the incumbent is proved best.

Scale. No task holds a conversation. Rows are laid out by range, so a long
conversation spreads over many tasks, and cut into segments of at most
``SEGMENT`` rows. A segment is first summed up as the least cost between any
two states; a pass from each conversation's last segment to its first carries
the cost of all that follows, which is the end cost of the segment's search.
The search runs per segment for each state it can be entered in; the last pass
streams rows and audits in order, takes the audit of the state it is in, and
hashes the repaired text as it goes. That hash is one sequential computation,
so a conversation's rows meet in one task there, as a stream.

Defined cases: a null role or text counts as one space; null turns come first;
rows equal in turn follow by role, then by the SHA-256 of role and text; a null
conv_id is one conversation; rows repeated in full are duplicates; a table
without rows gives none; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import materialize, release, table
from airshed.session import shuffle_partitions

#: Rows that one search covers.
SEGMENT = 4096

# Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 1, 2, 5, 5

# States of the role pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after the user or assistant turn that has to come next.
NEXT = (USER, USER, ASSISTANT, USER)
#: Inserts that end a conversation in each state.
CLOSING = ("", "II", "I", "")
FAR = 1 << 60

# A row's code: its role's initial, and its fault times 4.
OTHER, IS_SYSTEM, IS_USER, IS_ASSISTANT = range(4)
BLANK, DUPLICATE, CUT = 1, 2, 3
#: Neighbouring initials that are no fault.
LEGAL = {(IS_SYSTEM, IS_USER), (IS_USER, IS_ASSISTANT), (IS_ASSISTANT, IS_USER)}


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits that take this row."""
    out = [("D", DELETE, state)]
    role, fault = code & 3, code >> 2
    if fault in (BLANK, DUPLICATE):
        return out
    stays = TRUNCATED_STAYS if fault == CUT else 0
    if role == IS_SYSTEM and state == START:
        out.append(("K", stays, SYSTEM))
    elif role == (IS_ASSISTANT if state == USER else IS_USER):
        out.append(("K", stays, NEXT[state]))
    out.append(("R", stays + REROLE, NEXT[state]))
    return out


MOVES = [[_moves(code, state) for state in STATES] for code in range(16)]


def suffix_bounds(codes: bytes, end: list[int]) -> list[list[int]]:
    """Least cost from every (row, state) to the end, where ``end`` is due."""
    rows = [list(end)]
    for code in reversed(codes):
        after = rows[-1]
        least = [min(cost + after[to] for _, cost, to in MOVES[code][state]) for state in STATES]
        user, assistant = least[USER], least[ASSISTANT]
        least[USER], least[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
        for state in (START, SYSTEM):
            least[state] = min(least[state], INSERT + least[USER])
        rows.append(least)
    rows.reverse()
    return rows


class Repair(NamedTuple):
    cost: int  # of the edits, without what is due at the end
    audit: str
    state: int  # at the end


def search(codes: bytes, state: int, end: list[int]) -> Repair | None:
    """Cheapest, then ASCII-least edits of the rows from ``state``; None if no
    edits lead to a state with an end."""
    bound = suffix_bounds(codes, end)
    if bound[0][state] >= FAR:
        return None
    n, best, path = len(codes), None, bytearray()
    limit = FAR
    reached: dict[tuple[int, int], int] = {}
    stack = [(0, state, 0, 0, 0)]  # row, state, cost, edits before, last edit
    while stack:
        row, at, cost, depth, edit = stack.pop()
        del path[max(depth - 1, 0) :]
        if depth:
            path.append(edit)
        if cost + bound[row][at] > limit or cost >= reached.get((row, at), FAR):
            continue
        if best is not None and cost + bound[row][at] == limit and bytes(path) > best[1][: len(path)]:
            continue
        reached[row, at] = cost
        if row == n:
            limit, best = cost + end[at], (cost, bytes(path), at)
            continue
        children = [(row, NEXT[at], cost + INSERT, "I")]
        children += [(row + 1, to, cost + price, name) for name, price, to in MOVES[codes[row]][at]]
        children = [c for c in children if c[2] + bound[c[0]][c[1]] <= limit]
        children.sort(key=lambda c: (c[2] + bound[c[0]][c[1]], c[3]), reverse=True)
        stack += [(to_row, to, price, depth + 1, ord(name)) for to_row, to, price, name in children]
    return Repair(best[0], best[1].decode(), best[2])


# ---------------------------------------------------------------------------
# Tasks
# ---------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _segmenter(limit: int) -> Callable:
    """Rows (conv, ord, code) in order -> segments with their costs by state."""
    schema = pa.schema([("conv", pa.int64()), ("seg", pa.int64()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64()))])

    def summed(conv, first, codes: bytes) -> tuple:
        columns = [suffix_bounds(codes, [0 if s == to else FAR for s in STATES])[0] for to in STATES]
        return conv, first, codes, [min(columns[to][at], FAR) for at in STATES for to in STATES]

    def segments(rows):
        conv, first, codes = None, None, bytearray()
        for key, place, code in rows:
            if codes and (key != conv or len(codes) == limit):
                yield summed(conv, first, bytes(codes))
                codes = bytearray()
            if not codes:
                conv, first = key, place
            codes.append(code)
        if codes:
            yield summed(conv, first, bytes(codes))

    return lambda batches: _emit(segments(_rows(batches)), schema)


SEGMENTS = "conv long, seg long, codes binary, costs array<long>"
_CHOICE = pa.list_(pa.struct([("state", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("to", pa.int32())]))
CHOICES = "conv long, seg long, codes binary, choices array<struct<state:int,cost:long,audit:string,to:int>>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation, last first -> their searches by entry state."""
    schema = pa.schema([("conv", pa.int64()), ("seg", pa.int64()), ("codes", pa.binary()), ("choices", _CHOICE)])

    def solved(row, end, last, first):
        conv, seg, codes, _ = row
        found = []
        for state in (START,) if first else STATES:
            if repair := search(codes, state, end):
                tail = CLOSING[repair.state] if last else ""
                found.append({"state": state, "cost": repair.cost + INSERT * len(tail), "audit": repair.audit + tail, "to": repair.state})
        return conv, seg, codes, found

    def run():
        held, end, last = None, None, True
        for row in _rows(batches):
            if held is not None:
                same = row[0] == held[0]
                yield solved(held, end, last, not same)
                last = not same
                costs = held[3]
                end = [min(costs[4 * at + to] + end[to] for to in STATES) for at in STATES]
            if last:
                end = [INSERT * len(c) for c in CLOSING]
            held = row
        if held is not None:
            yield solved(held, end, last, True)

    return _emit(run(), schema, 64)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (conv, ord, kind, role, text, codes, choices) by conv, ord, kind: a
    segment (kind 0) comes just before its rows. Yields (conv, "segment",
    cost, audit, codes) for every segment, (conv, "turn", edit, role, text) for
    every turn of the repaired conversation."""
    before: object = _streamed
    for conv, _, kind, role, text, codes, choices in _rows(batches):
        if kind == 0:
            if conv != before or type(conv) is not type(before):
                state, before = START, conv
            chosen = next(c for c in choices if c["state"] == state)
            edits, at, state = iter(chosen["audit"]), state, chosen["to"]
            yield conv, "segment", chosen["cost"], chosen["audit"], codes
            left = len(codes)
            continue
        for edit in edits:
            if edit == "I":
                at = NEXT[at]
                yield conv, "turn", edit, "assistant" if at == ASSISTANT else "user", ""
                continue
            if edit == "K":
                at = SYSTEM if at == START and role[:1] == "s" else NEXT[at]
                yield conv, "turn", edit, role, text
            elif edit == "R":
                at = NEXT[at]
                yield conv, "turn", edit, "assistant" if at == ASSISTANT else "user", text
            break
        left -= 1
        if not left:  # inserts that close the conversation
            for edit in edits:
                at = NEXT[at]
                yield conv, "turn", edit, "assistant" if at == ASSISTANT else "user", ""


TURNS = "conv_id long, pos long, edit string, role string, text string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def run():
        before, pos = _turns, 0
        for conv, what, edit, role, text in _streamed(batches):
            if what == "turn":
                pos = 0 if conv != before or type(conv) is not type(before) else pos + 1
                before = conv
                yield conv, pos, edit, role, text

    return _emit(run(), schema, 64)


AUDITS = "conv long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv", pa.int64()), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run():
        before: object = _audits
        for conv, what, x, y, z in _streamed(batches):
            if conv != before or type(conv) is not type(before):
                if before is not _audits:
                    yield before, *counts, "".join(audit), digest.hexdigest()
                before, counts, audit, digest, last, first = conv, [0] * 5, [], hashlib.sha256(), None, True
            if what == "segment":
                counts[4] += x
                audit.append(y)
                for code in z:
                    role, fault = code & 3, code >> 2
                    if fault:
                        counts[fault - 1] += 1
                    counts[3] += last is not None and (last, role) not in LEGAL
                    last = role
            else:
                digest.update(f"{'' if first else chr(10)}{y}:{z}".encode())
                first = False
        if before is not _audits:
            yield before, *counts, "".join(audit), digest.hexdigest()

    return _emit(run(), schema, 64)


# ---------------------------------------------------------------------------
# Plan
# ---------------------------------------------------------------------------


def _coded(laid: DataFrame) -> DataFrame:
    """conv, ord, code of the laid out rows."""
    firsts = laid.groupBy("conv", "digest").agg(F.min("ord").alias("ord")).select("ord", F.lit(True).alias("_first"))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", IS_SYSTEM).when(letter == "u", IS_USER).when(letter == "a", IS_ASSISTANT).otherwise(OTHER)
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    ends = F.substring(solid, -1, 1).isin(".", "!", "?")
    rows = laid.select("conv", "ord", initial.alias("_role"), F.when(solid == "", BLANK).when(~ends, CUT).otherwise(0).alias("_fault"))
    rows = rows.join(firsts, "ord", "left")
    fault = F.when((F.col("_fault") != BLANK) & F.col("_first").isNull(), DUPLICATE).otherwise(F.col("_fault"))
    return rows.select("conv", "ord", (F.col("_role") + 4 * fault).cast("int").alias("code"))


def _planned(turns: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows and the audits to choose from, in streaming order; laid out rows)."""
    n = shuffle_partitions(turns.sparkSession)
    space = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest")
    )
    order = ["conv", "turn", "role", "digest"]
    laid = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("ord", F.monotonically_increasing_id())
    laid = materialize(laid, "turns-laid")
    coded = _coded(laid).repartitionByRange(n, "ord").sortWithinPartitions("ord")
    segments = coded.mapInArrow(_segmenter(limit), SEGMENTS)
    solved = segments.repartition(n, "conv").sortWithinPartitions("conv", F.desc("seg")).mapInArrow(_solve, CHOICES)
    kinds = CHOICES.split("choices ")[1]
    text_rows = laid.select("conv", "ord", F.lit(1).alias("kind"), "role", "text", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast(kinds).alias("choices"))
    empty = F.lit(None).cast("string")
    audit_rows = solved.select("conv", F.col("seg").alias("ord"), F.lit(0).alias("kind"), empty.alias("role"), empty.alias("text"), "codes", "choices")
    both = text_rows.unionByName(audit_rows).repartition(n, "conv").sortWithinPartitions("conv", "ord", "kind")
    return both, laid


def repair(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Turns (conv_id, turn, role, text) -> the repaired conversations: conv_id,
    pos (from 0), edit (K, R or I), role, text."""
    return _planned(turns, segment)[0].mapInArrow(_turns, TURNS)


def audit(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of turns: conv_id, gaps, the counts of faults,
    illegal neighbours, cost, audit and the hash of the repaired conversation."""
    both, laid = _planned(turns, segment)
    found = materialize(both.mapInArrow(_audits, AUDITS), "turn-audits")
    turn = F.col("turn")
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0))
    spans = materialize(laid.groupBy(F.col("conv").alias("conv_id")).agg(gaps.cast("long").alias("gaps")), "turn-gaps")
    release(laid)
    return spans.join(found, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")


def damage(conversations: DataFrame) -> DataFrame:
    """The query's damage: dealt to rows by crc32 of ``conv_id:turn`` modulo 20."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), fate.alias("_fate")).where("_fate <> 0")
    text: Column = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("_fate") == 3, 2).otherwise(1)
    rows = rows.withColumns({"text": text, "role": F.when(F.col("_fate") == 4, "user").otherwise(F.col("role"))})
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def q_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: faults, cheapest edits and repaired hash of every conversation."""
    conversations = table(spark, sf_dir, "conversations")
    found = audit(damage(conversations)).withColumnRenamed("conv_id", "_id")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


#: A recursive step per row keeps the least (cost, audit) of every state.
ORACLE = """
WITH RECURSIVE table_ AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t),
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
fated AS (
  SELECT src.*, xor(list_reduce(list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) % 256) + 1]), 4294967295), 4294967295) % 20 AS fate FROM src, table_),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i FROM damaged),
marked AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS c, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS solid,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
coded AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM marked),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS st, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS b FROM coded
  UNION ALL
  SELECT conv_id, i, st, min(b) FROM (
    SELECT conv_id, i, CASE e WHEN 'D' THEN st1 WHEN 'K' THEN (CASE WHEN c = 's' THEN 1 ELSE nxt END) ELSE nxt END AS st,
           {'cost': cost + CASE e WHEN 'D' THEN 2 ELSE (CASE e WHEN 'R' THEN 1 ELSE 0 END) + (CASE fault WHEN 'truncated' THEN 5 ELSE 0 END) END, 'audit': audit || e} AS b
    FROM (SELECT *, CASE WHEN st1 = 2 THEN 3 ELSE 2 END AS nxt FROM (
            SELECT best.conv_id, coded.i, coded.c, coded.fault, best.b.cost + 5 * ins.k AS cost, best.b.audit || repeat('I', CAST(ins.k AS INTEGER)) AS audit,
                   CASE ins.k WHEN 0 THEN best.st WHEN 1 THEN (CASE WHEN best.st = 2 THEN 3 ELSE 2 END) ELSE (CASE WHEN best.st = 2 THEN 2 ELSE 3 END) END AS st1
            FROM best JOIN coded ON coded.conv_id IS NOT DISTINCT FROM best.conv_id AND coded.i = best.i + 1
            CROSS JOIN (VALUES (0), (1), (2)) ins(k)))
    CROSS JOIN (VALUES ('D'), ('K'), ('R')) edit(e)
    WHERE e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR (c = 's' AND st1 = 0) OR (c = 'u' AND nxt = 2) OR (c = 'a' AND nxt = 3))))
  GROUP BY conv_id, i, st),
ended AS (
  SELECT conv_id, min({'cost': b.cost + CASE st WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, 'audit': b.audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS b
  FROM best JOIN (SELECT conv_id AS c_, max(i) AS n FROM coded GROUP BY 1) ON best.conv_id IS NOT DISTINCT FROM c_ AND i = n GROUP BY conv_id),
edits AS (
  SELECT conv_id, k, e, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS pos
  FROM (SELECT conv_id, unnest(range(length(b.audit))) AS k, unnest(string_split(b.audit, '')) AS e FROM ended WHERE b.audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
turns AS (
  SELECT edits.conv_id, k, e, pos, coded.role AS role, CASE e WHEN 'I' THEN '' ELSE coded.text END AS text,
         max(CAST(pos = 1 AND e = 'K' AND c = 's' AS INTEGER)) OVER (PARTITION BY edits.conv_id) AS sys
  FROM edits LEFT JOIN coded ON coded.conv_id IS NOT DISTINCT FROM edits.conv_id AND coded.i = edits.i WHERE e <> 'D'),
hashed AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (pos - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k)) AS h
  FROM turns GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id FROM conversations) o
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed ON hashed.conv_id IS NOT DISTINCT FROM o.conv_id
"""
