"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it again as the next stage's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import decontaminate, mixing, near_dedup, quality_rules, token_ids
from airshed.llm.common import materialize, table, words_col
from airshed.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all documents, those whose id is null or repeated), each with ``_row``: a
    long that no other row has. It is the id where that is given once; the other
    rows, written once so that their numbers hold, count on above all ids (which
    have to be below 2^62). Verdicts are joined by it, so no row shares the fate
    of one that happens to have its id."""
    docs = _documents(docs)
    doc_id = F.col("doc_id").cast("long")
    ids = docs.where("doc_id IS NOT NULL").groupBy(doc_id.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    above = (ids.agg(F.max("_id")).first()[0] or 0) + 1
    repeated = materialize(ids.where("_n > 1").select("_id"), "pipeline-repeated-ids")
    odd = docs.where("doc_id IS NULL").unionByName(docs.join(repeated, doc_id == F.col("_id"), "left_semi"))
    odd = materialize(odd.withColumn("_row", F.lit(max(above, 1)).cast("long") + F.monotonically_increasing_id()), "pipeline-odd-rows")
    once = docs.where("doc_id IS NOT NULL").join(repeated, doc_id == F.col("_id"), "left_anti").withColumn("_row", doc_id)
    return once.unionByName(odd), odd


def _as_docs(rows: DataFrame) -> DataFrame:
    """The rows with ``_row`` in the place of their id."""
    return rows.select(F.col("_row").alias("doc_id"), "text", "lang", "source", "n_chars")


def _with(rows: DataFrame, verdict: DataFrame, how: str) -> DataFrame:
    """Rows with (left_semi) or without (left_anti) their key in verdict."""
    keys = verdict.select(F.col("doc_id").alias("_key")).distinct()
    return _documents(rows.join(keys, F.col("_row") == F.col("_key"), how))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject (op4), each row by its
    own verdict. Null and empty texts have too few words and go; a label counts
    for every row of its id; an empty table gives an empty result; only the
    columns of documents are read."""
    rows, odd = _keyed(docs)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    own = labels.join(odd.select(F.col("doc_id").alias("_doc"), "_row"), F.col("doc_id") == F.col("_doc"))
    labels = labels.unionByName(own.select(F.col("_row").alias("doc_id"), "quality"))
    judged = quality_rules.quality(_as_docs(rows), labels)
    return _with(rows, judged.where("kept"), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id (op3's
    method, with five words and 80 %); a null id is greater than any, and of
    rows that share an id one stays if their texts are of one group. Texts
    without words are linked with nothing and stay; an empty table gives an
    empty result; only the columns of documents are read."""
    rows, odd = _keyed(docs)
    judged = near_dedup.near_duplicates(_as_docs(rows), width=5, percent=80).select(F.col("doc_id").alias("_key"), "component_id")
    named = judged.join(odd.select("_row", "doc_id"), F.col("_key") == F.col("_row"), "left")
    given = F.when(F.col("_row").isNull(), F.col("_key")).otherwise(F.col("doc_id").cast("long"))
    first = F.min(F.struct(given.isNull(), given, F.col("_key"))).alias("_first")
    kept = named.groupBy("component_id").agg(first).select(F.col("_first._key").alias("doc_id"))
    return _with(rows, kept, "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item (op1), each row by its own
    verdict: clean rows that share an id, or have none, stay. Null and empty
    texts hold nothing; an empty table, or an empty benchmark, drops nothing;
    only the columns of documents are read."""
    rows, _ = _keyed(docs)
    found = decontaminate.leaks(_as_docs(rows), table(spark, sf_dir, "benchmark"))
    return _with(rows, found, "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them (op6): a row per pass over a document.
    One that straddles its source's cut gives its first words up to the cut,
    joined by spaces. Rows equal in id and text are taken as often as the mix
    takes them together."""
    docs = _documents(docs).withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    plan = mixing.schedule(mixing.mix(docs))
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_row"), "words", "size")
    rows = docs.dropDuplicates(["doc_id", "_key"])
    rows = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_row")))
    cut = F.array_join(F.slice(words_col(F.col("text")), 1, F.col("words").cast("int")), " ")
    whole = F.col("words") >= F.col("size")
    text = F.when(whole, F.col("text")).otherwise(cut)
    n_chars = F.when(whole, F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return rows.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in the binary format and read back (op10): a row per
    document, null texts as empty ones; an empty table gives an empty result."""
    dest = scratch_path(spark, "pipeline-ids")
    token_ids.write_ids(docs, dest)
    return token_ids.read_ids(spark, dest)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token ids", tokens),
]

#: The stages' methods (likelihood ratio, minhash, latent search, coder) are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
