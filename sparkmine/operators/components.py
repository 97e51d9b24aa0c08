"""Connected components and ranks of their representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.ordered import running_sums
from sparkmine.lineage import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id for every id in ``edges (a, b)``: ``(id, root)``.

    Alternating large-star and small-star rounds: every node is re-linked to the
    smallest node in its neighbourhood, which halves chains instead of walking them.
    Minima are pre-aggregated before the shuffle; a hub's edges are split by
    adaptive skew handling on the join that follows.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    signature = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
    was = signature(e)
    while was[0]:
        # large star: link the larger end of every edge to the minimum around the smaller one
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
        large = e.join(low, e["v"] == low["w"]).select("u", F.col("m").alias("v")).distinct()
        # small star: link the smaller neighbours of u, and u itself, to their minimum
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = (
            moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        )
        e = cut(small)
        now = signature(e)
        if now == was:
            break
        was = now
    roots = e.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def number_by_order(roots: DataFrame, root_col: str, *, start: int = 1) -> DataFrame:
    """``(root, number)``: distinct roots numbered in ascending order."""
    distinct = roots.select(F.col(root_col).alias("root")).distinct().withColumn("_one", F.lit(1))
    ranked = running_sums(distinct, [], "root", ["_one"])
    return ranked.select("root", (F.col("cum__one") - 1 + start).cast("int").alias("number"))
