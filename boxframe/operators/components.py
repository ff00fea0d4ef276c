"""Connected components of an edge table, by alternating star contractions.

Each round hangs every node's larger neighbours on the smallest node around it
(large star), then its smaller neighbours too (small star). A path of n nodes
settles in about log n rounds. Hubs meet in aggregations, which combine before
the shuffle, and in equi-joins, which the adaptive planner splits; every round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.session import cut_lineage, cut_lineage_observed


def label_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` of every node of ``edges`` (a, b) that is not the smallest of its component.

    Nodes may be of any type that can be ordered; self loops and repeated edges are fine.
    """
    star = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    seen = None
    for _ in range(max_rounds):
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        hung = both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
        least = hung.groupBy("a").agg(F.min("b").alias("_m"))
        moved = hung.join(least, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        star, mark = cut_lineage_observed(
            moved.unionByName(least.select("a", F.col("_m").alias("b"))).distinct(), "star",
            n=F.count(F.lit(1)), checksum=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        if mark == seen or not mark["n"]:
            return star.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
