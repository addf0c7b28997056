"""Personal data: fixed patterns, and contextual patterns learnt from them.

Base spans of four kinds come from fixed expressions. They are the seeds of
a bootstrap: what stands to the left of an entity is its lexical pattern (the
two words before it, or one word that ends like a label). Pattern and instance
form a graph; other identifier-like strings (digit groups, things around an @
or an "(at)") are instances of unknown kind. In each round

* a pattern's confidence for a kind is the belief in its instances of that
  kind over the number of all its different instances plus one, if at least
  MIN_SUPPORT believed instances support it;
* an unknown instance's belief is the noisy-or of its patterns' confidences of
  at least MIN_CONFIDENCE.

Each round is a few joins and aggregates over the graph; the scan of the texts
before it is one pass that keeps positions and contexts only. Occurrences of
unknown instances that are believed and stand in a confident pattern are added
as spans; base spans stay, and added ones never overlap them.

Defined cases: null or empty text has no span; rows with the same id are
scanned each on their own; without seeds nothing is added; an empty table gives
an empty result; only the named columns are read.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import column, materialize, release, small_batches, table

#: The kinds in the order of the result.
KINDS = ("email", "ip", "card", "phone")

MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.7
ROUNDS = 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failing match at the first digit of a run fails at its others too
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER_RUN = re.compile(r"[0-9() ./-]{7,}")
_AROUND_AT = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}")
_SPELLED_AT = re.compile(r"[\w.+-]{1,64} ?[(\[]at[)\]] ?[\w-]{1,63}(?:(?:\.| ?[(\[]dot[)\]] ?)[\w-]{1,63})+", re.IGNORECASE)
_WORD = re.compile(r"\S+")

_SPANS = "array<struct<kind:int,start:int,end:int>>"
_SCAN_DDL = f"doc_id long, row_key long, base {_SPANS}, seen array<struct<kind:int,start:int,end:int,instance:long,patterns:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @: the local part is all before it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        last = m.end() if m else at + 1
        at = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in order of kind and start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((3, *m.span()))
    return out


def _unknown(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like strings that overlap no base span. The base spans
    are sorted once, so a candidate takes one bisection."""
    taken = sorted(taken)
    starts = [a for a, _ in taken]
    furthest = list(itertools.accumulate((b for _, b in taken), max))

    def free(s, e):
        before = bisect.bisect_left(starts, e)  # those that begin before the candidate's end
        return not before or furthest[before - 1] <= s

    if _DIGIT.search(text):
        for m in _NUMBER_RUN.finditer(text):
            digits = [i for i in range(*m.span()) if "0" <= text[i] <= "9"]
            if len(digits) >= 7 and free(digits[0], digits[-1] + 1):
                yield digits[0], digits[-1] + 1
    if "@" in text:
        for m in _AROUND_AT.finditer(text):
            if free(*m.span()):
                yield m.span()
    if "at" in text or "AT" in text or "At" in text:
        for m in _SPELLED_AT.finditer(text):
            if free(*m.span()):
                yield m.span()


_CUT_WORD = re.compile(r"^\S+")


def _patterns(text: str, start: int) -> list[str]:
    """Lexical patterns to the left, on the same line, digits made alike."""
    line = text.rfind("\n", max(0, start - 81), start) + 1
    cut = max(0, start - 80, line)
    left = text[cut:start]
    if cut and cut != line and not text[cut - 1].isspace():
        left = _CUT_WORD.sub("", left)  # never a part of a word
    words = [_DIGIT.sub("9", w.lower()) for w in _WORD.findall(left)[-2:]]
    out = [" ".join(words)] if len(words) == 2 else []
    return out + ([words[-1]] if words and words[-1][-1] in ":=" else [])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    seen_type = pa.list_(pa.struct([*span, ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))]))
    for b in batches:
        base, seen = [], []
        for text in column(b, "text").to_pylist():
            text = text or ""
            found = base_spans(text)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            both = found + [(-1, s, e) for s, e in _unknown(text, [(s, e) for _, s, e in found])]
            seen.append([
                {"kind": k, "start": s, "end": e, "instance": xxhash.xxh3_64_intdigest(text[s:e].lower()) - (1 << 63), "patterns": p}
                for k, s, e in both if (p := _patterns(text, s))
            ])
        cols = [column(b, "doc_id"), column(b, "row_key"), pa.array(base, pa.list_(pa.struct(span))), pa.array(seen, seen_type)]
        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row_key", "base", "seen"])


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """edges (pattern, instance, kind; kind -1 is unknown), distinct. Returns the
    confident patterns (pattern, kind, confidence) and beliefs (instance, kind, belief)."""
    known = edges.where("kind >= 0").select("pattern", "instance", "kind", F.lit(1.0).alias("belief"))
    unknown = edges.where("kind < 0").select("pattern", "instance")
    totals = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("_all"))
    beliefs = None
    for _ in range(rounds):
        held = known if beliefs is None else known.unionByName(unknown.join(beliefs, "instance").select(*known.columns))
        support = held.groupBy("pattern", "kind").agg(F.sum("belief").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        scored = support.where(F.col("_n") >= MIN_SUPPORT).join(totals, "pattern")
        confidence = (F.col("_sum") / (F.col("_all") + 1)).alias("confidence")
        patterns = materialize(scored.select("pattern", "kind", confidence).where(F.col("confidence") >= MIN_CONFIDENCE), "pii-patterns")
        doubt = F.sum(F.log1p(-F.col("confidence")))
        raised = unknown.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("belief"))
        best = raised.groupBy("instance").agg(F.max(F.struct("belief", -F.col("kind"))).alias("_b"))
        beliefs = materialize(best.select("instance", (-F.col("_b")["col2"]).alias("kind"), F.col("_b.belief").alias("belief")), "pii-beliefs")
    return patterns, beliefs


def _written(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, row_key, base and all spans (kind, start, end; code points)."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), text.alias("text"))
    scanned = materialize(rows.mapInArrow(_scan, _SCAN_DDL), "pii-scan")
    places = scanned.select("doc_id", "row_key", F.explode("seen").alias("_s"))
    edges = places.select(F.explode("_s.patterns").alias("pattern"), "_s.instance", "_s.kind").distinct()
    edges = materialize(edges, "pii-edges")
    patterns, beliefs = score_graph(edges)
    release(edges)
    unknown = places.where("_s.kind < 0").select("doc_id", "row_key", "_s.start", "_s.end", "_s.instance", F.explode("_s.patterns").alias("pattern"))
    believed = beliefs.where(F.col("belief") >= MIN_CONFIDENCE).select("instance", "kind")
    added = unknown.join(patterns.select("pattern", "kind"), "pattern").join(believed, ["instance", "kind"])
    per_row = added.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("_added"))
    per_row = per_row.withColumnsRenamed({"doc_id": "_d", "row_key": "_k"})
    joined = scanned.join(per_row, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row_key") == F.col("_k")), "left")
    every = F.sort_array(F.concat("base", F.coalesce("_added", F.array().cast(_SPANS))))
    return joined.select("doc_id", "row_key", "base", every.alias("spans"))


def q_pii(spark, sf_dir: str) -> DataFrame:
    """op2: base counts and digest, all spans, and how many the method added."""
    found = find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )
