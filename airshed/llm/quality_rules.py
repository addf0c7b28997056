"""Quality rules: Gopher-like base counts and a hashed n-gram likelihood ratio.

The method: two multinomials over hashed n-grams of word shapes, one of
trusted documents, one of the raw corpus. A document's score is the mean over
its n-grams of log(p_trusted / p_raw), so it does not depend on length; every
document at or over a fixed threshold passes. A shape keeps what prose and
junk differ in, not what they are about: runs of lower-case letters become
``a``, of upper-case letters ``A``, of digits ``9``; all else stays.

Only DataFrame functions are used. The raw counts cover every document, the
trusted counts every document labelled quality 1. One pass over the texts makes
the base counts and the buckets of the n-grams, written once; both the model
and the scores read these. The labels are joined to rows of buckets, not of
texts, by whatever join their size asks for, and the n-grams are counted by a
partial aggregate over BUCKETS keys. The model (BUCKETS doubles) reaches the
tasks as a scalar subquery; texts never move.

Repeats inside a text: the 8-word windows are hashed in the row; only rows in
which a hash occurs twice sort their windows, so the cost stays n log n.

Defined cases: null or empty text has no words, fails the base rules and is
not kept; a text of fewer than N words is one n-gram; without any trusted
document all scores are equal and the base rules decide; ids may be null or
repeated, each row is judged alone; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import SPACE_RE, materialize, release, table, words_col

#: The base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS_RE = r"[#*$%&|<>]"

#: Parameters of the method.
N = 3
BUCKETS = 4096
THRESHOLD = -0.3


def shape(text: Column) -> Column:
    lower = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{Ll}\p{Lo}\p{Lm}\p{M}]+", "a")
    return F.regexp_replace(F.regexp_replace(lower, r"[\p{Lu}\p{Lt}]+", "A"), "[0-9]+", "9")


def _windows(words: str, width: int) -> Column:
    """64-bit hash of every window of ``width`` words of an array column."""
    last = F.size(words) - width
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, width)))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def gram_buckets(shapes: str) -> Column:
    """Bucket of every n-gram; a shorter text is one n-gram, an empty one none."""
    n = F.size(shapes)
    many = F.transform(
        F.sequence(F.lit(0), n - N),
        lambda i: F.pmod(F.xxhash64(*[F.get(F.col(shapes), i + k) for k in range(N)]), F.lit(BUCKETS)).cast("int"),
    )
    one = F.array(F.pmod(F.xxhash64(F.col(shapes)), F.lit(BUCKETS)).cast("int"))
    return F.when(n >= N, many).when(n > 0, one).otherwise(F.array().cast("array<int>"))


def likelihood_model(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, one array: log(p_trusted / p_raw) by bucket, add-one smoothed.
    ``rows`` has doc_id and the buckets of its n-grams, in _grams."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id")
    trusted = rows.select("doc_id", "_grams").join(good, "doc_id", "left_semi")
    grams = rows.select(F.lit(0).alias("_t"), F.explode("_grams").alias("bucket"))
    grams = grams.union(trusted.select(F.lit(1), F.explode("_grams")))
    counts = grams.groupBy("bucket").agg(F.sum(1 - F.col("_t")).alias("_raw"), F.sum("_t").alias("_trusted"))
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(counts, "bucket", "left").select(
        "bucket", *[(F.coalesce(F.col(c), F.lit(0)) + 1).cast("double").alias(c) for c in ("_raw", "_trusted")]
    )
    cells = F.sort_array(F.collect_list(F.struct("bucket", "_raw", "_trusted")))
    packed = dense.agg(cells.alias("_m"), F.sum("_raw").alias("_r"), F.sum("_trusted").alias("_t"))
    ratio = F.transform("_m", lambda x: F.log(x["_trusted"] / F.col("_t")) - F.log(x["_raw"] / F.col("_r")))
    return packed.select(ratio.alias("model"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the shape words of every text, in _shapes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(
        "doc_id",
        words_col(F.col("text")).alias("_words"),
        F.regexp_count(text, F.lit(SYMBOLS_RE)).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.array_remove(F.split(shape(F.col("text")), SPACE_RE), "").alias("_shapes"),
    )
    rows = rows.select(
        "doc_id",
        "n_symbols",
        "_shapes",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _windows("_words", WINDOW).alias("_hashes"),
    )
    keep = [c for c in rows.columns if c != "_hashes"]
    # (hash, position) in order, only where some window occurs twice
    pairs = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(*keep, F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), pairs).alias("_pairs"))
    near = lambda j: F.get(F.col("_pairs"), j)["h"]
    twice = F.filter("_pairs", lambda p, j: near(j - 1).eqNullSafe(p["h"]) | near(j + 1).eqNullSafe(p["h"]))
    rows = rows.select(*keep, F.sort_array(F.transform(twice, lambda p: p["i"])).alias("_at"))
    # words under the union of the repeated windows
    step = F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), j + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(*keep, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The base counts, base_failed, the score of the method and the verdict."""
    base = base_counts(docs)
    base = base.select(*[c for c in base.columns if c != "_shapes"], gram_buckets("_shapes").cast("array<smallint>").alias("_grams"))
    base = materialize(base, "quality-grams")
    rows = base.withColumn("_model", likelihood_model(base, labels).scalar())
    total = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get(F.col("_model"), g.cast("int")))
    rows = rows.withColumn("score", F.when(F.size("_grams") > 0, total / F.size("_grams"))).drop("_grams", "_model")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    # a filter on the verdict must not be pushed into the array expressions
    judged = materialize(rows, "quality")
    release(base)
    return judged


def q_quality_rules(spark, sf_dir: str) -> DataFrame:
    """op4: base counts and verdict of every document."""
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("score", 6).alias("score")
    )
