"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by the md5 of their id. A document's
virtual finish time is the number of its source's words up to and including
it, divided by the source's target; one more pass over the source adds one
source size. Sorting all documents by finish time globally interleaves the
sources in proportion to their targets, and the total budget is used up at
virtual time 1: what lies beyond is cut off, the document that straddles the
cut in its source gives only the words that still fit.

The running sums are exact and distributed: words are summed per (source,
first byte, second byte of the md5), the 256 sums of a level are accumulated
in a window of at most 256 rows, and rows inside a cell in a window of
1/65,536 of the source. No window holds a whole source.

Defined cases: null text has size 0; the null source is a source of its own,
last in order; null ids are shuffled as the empty id; rows that share an id
follow by size, then by the hash of their text, so reruns agree on which text
is taken; rows repeated in full count as documents of their own; an empty table gives an empty result; sources of size
0 get target 0. Only the named columns are read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import WORD_RE, materialize, table

#: Weights by source order, budget and cap as shares of the sizes.
WEIGHTS = (3, 1, 2)
BUDGET_NUM, BUDGET_DEN = 3, 2
EPOCHS = 2

_BIG = "decimal(20,0)"


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target): the budget shared by weight, water-filled
    under the cap of EPOCHS times the source. One row per source throughout."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ranked = per_source.withColumn("_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.select(
        "source",
        "source_size",
        "_rank",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")).alias("_w"),
        F.sum("source_size").over(everything).alias("_total"),
    )
    by_ratio = Window.orderBy(F.col("source_size") / F.col("_w"), "_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Filled in order of size over weight, a source is full if its cap is at
    # most its share of what the fuller ones leave. All in exact integers.
    filled = ranked.select(
        "*",
        (BUDGET_NUM * F.col("_total") - BUDGET_DEN * EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_left"),
        F.sum("_w").over(after).alias("_wleft"),
    ).withColumn(
        "_full",
        (BUDGET_DEN * EPOCHS * F.col("source_size")).cast(_BIG) * F.col("_wleft").cast("decimal(17,0)")
        <= F.col("_left").cast(_BIG) * F.col("_w").cast("decimal(17,0)"),
    )
    left = BUDGET_NUM * F.col("_total") - BUDGET_DEN * EPOCHS * F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(everything)
    share = (F.col("_w") * left).cast("double") / (BUDGET_DEN * F.sum(F.when(~F.col("_full"), F.col("_w")).otherwise(0)).over(everything)).cast("double")
    target = F.when(F.col("_full"), (EPOCHS * F.col("source_size")).cast("double")).otherwise(share)
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """One row per document: doc_id, row_key (hash of the text), source, size,
    source_size, target, before (words of its source shuffled ahead of it),
    virtual_finish, taken."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    sized = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD_RE)).cast("long").alias("size"),
            key.alias("_key"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row_key"),
        ),
        "mix-sizes",
    ).withColumns({"_hi": F.substring("_key", 1, 2), "_lo": F.substring("_key", 3, 2)})
    running = Window.unboundedPreceding
    cells = sized.groupBy("source", "_hi", "_lo").agg(F.sum("size").alias("_n"))
    cells = cells.withColumn("_in_hi", F.sum("_n").over(Window.partitionBy("source", "_hi").orderBy("_lo").rowsBetween(running, -1)))
    blocks = sized.groupBy("source", "_hi").agg(F.sum("size").alias("_n"))
    blocks = blocks.select(
        F.col("source").alias("_s"),
        F.col("_hi").alias("_h"),
        F.sum("_n").over(Window.partitionBy("source").orderBy("_hi").rowsBetween(running, -1)).alias("_in_source"),
    )
    zero = F.lit(0).cast("long")
    offsets = cells.join(blocks, cells["source"].eqNullSafe(F.col("_s")) & (F.col("_hi") == F.col("_h"))).select(
        F.col("source").alias("_s"), F.col("_hi").alias("_h"), F.col("_lo").alias("_l"),
        (F.coalesce("_in_hi", zero) + F.coalesce("_in_source", zero)).alias("_off"),
    )
    in_cell = Window.partitionBy("source", "_hi", "_lo").orderBy("_key", "doc_id", "size", "row_key").rowsBetween(running, -1)
    rows = sized.withColumn("_in_cell", F.coalesce(F.sum("size").over(in_cell), zero))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_hi") == F.col("_h")) & (F.col("_lo") == F.col("_l")))
    rows = rows.select("doc_id", "row_key", "source", "size", (F.col("_off") + F.col("_in_cell")).alias("before"))
    targets = source_targets(sized, weights).withColumnRenamed("source", "_s")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return rows.withColumns(
        {
            "virtual_finish": F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target")),
            "taken": sum((_taken(e) for e in range(1, EPOCHS)), _taken(0)),
        }
    )


def _taken(epoch: int) -> Column:
    """Words of a document taken in a pass: up to the cut at virtual time 1."""
    room = F.floor("target") - F.col("before") - epoch * F.col("source_size")
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), room))


def schedule(mixed: DataFrame) -> DataFrame:
    """The mix in order: a row per document and pass that gives words, sorted
    globally by virtual finish time and cut at the budget (virtual time 1)."""
    per_pass = F.array(*[F.struct(F.lit(e).alias("epoch"), _taken(e).alias("words")) for e in range(EPOCHS)])
    rows = mixed.select("doc_id", "row_key", "source", "size", "before", "source_size", "target", F.explode(per_pass).alias("_p"))
    finish = (F.col("before") + F.col("_p.epoch") * F.col("source_size") + F.col("size")) / F.col("target")
    return (
        rows.where("_p.words > 0")
        .select("doc_id", "row_key", "source", "_p.epoch", "_p.words", "size", finish.alias("virtual_finish"))
        .orderBy("virtual_finish", "source", "epoch", "doc_id")
    )


def q_mix(spark, sf_dir: str) -> DataFrame:
    """op6: what the mix takes of every document, sorted by virtual finish time."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish").orderBy("virtual_finish", "doc_id")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
src AS (SELECT source, sum(size)::HUGEINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS r, sum(source_size) OVER () AS total FROM src),
weighed AS (SELECT *, [3, 1, 2][(r % 3 + 1)::INT]::HUGEINT AS w FROM ranked),
filled AS (
  SELECT *,
    3 * total - 4 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
    sum(w) OVER (ORDER BY source_size::DOUBLE / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
  FROM weighed),
flagged AS (SELECT *, 4 * source_size * wl <= l * w AS is_full FROM filled),
targets AS (
  SELECT source, source_size::BIGINT AS source_size,
    CASE WHEN is_full THEN (2 * source_size)::DOUBLE
         ELSE (w * (3 * total - 4 * sum(CASE WHEN is_full THEN source_size ELSE 0 END) OVER ()))::DOUBLE
              / (2 * sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
  FROM flagged),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target)::BIGINT - b))
   + greatest(0, least(size, floor(target)::BIGINT - b - source_size)))::BIGINT AS taken,
  CASE WHEN target > 0 THEN (b + size)::DOUBLE / target END AS virtual_finish
FROM queued
"""
