"""Connected components of a link table by contraction.

Ids are first replaced by their xxhash64 (a bijection on longs), so that their
order is random. In a round every node takes the smallest id among itself and
its neighbours, and links are rewritten to the ids taken; links within an id
go. The number of ids falls by a constant share per round. All state is in
scratch tables; nothing is collected, hubs are only ever aggregated or joined
(a join that Spark can split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import materialize, release


def components(links: DataFrame) -> DataFrame:
    """links (a, b): longs. Returns node, component: the smallest node reachable.
    Nodes without a link to another one are absent."""
    h = lambda c: F.xxhash64(F.col(c).cast("long"))
    ends = links.where("a <> b")
    edges = materialize(ends.select(h("a").alias("a"), h("b").alias("b")).distinct(), "cc-links")
    both = ends.select(F.explode(F.array(F.col("a").cast("long"), F.col("b").cast("long"))).alias("node")).distinct()
    labels = materialize(both.select("node", h("node").alias("at")), "cc-labels")
    while not edges.isEmpty():
        near = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).groupBy("a").agg(F.min("b").alias("_b"))
        taken = materialize(near.select(F.col("a").alias("_from"), F.least("a", "_b").alias("_to")), "cc-taken")
        moved = labels.join(taken, F.col("at") == F.col("_from"), "left").select("node", F.coalesce("_to", "at").alias("at"))
        new_labels = materialize(moved, "cc-labels")
        left = edges.join(taken, F.col("a") == F.col("_from")).select(F.col("_to").alias("a"), "b")
        right = left.join(taken, F.col("b") == F.col("_from")).select("a", F.col("_to").alias("b"))
        new_edges = materialize(right.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
        for old in (edges, labels, taken):
            release(old)
        edges, labels = new_edges, new_labels
    release(edges)
    smallest = labels.groupBy("at").agg(F.min("node").alias("component")).withColumnRenamed("at", "_at")
    return labels.join(smallest, F.col("at") == F.col("_at")).select("node", "component")
