"""Connected components by alternating large-star and small-star rounds, each written as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    far = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return far.unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) for every node of ``edges`` (a, b) but the roots themselves.

    Self loops and repeated edges are allowed. Every round is written to the
    shared folder, so a lost executor costs one round at most. Hubs only meet
    in aggregations (combined before the shuffle) and equi-joins (which the
    adaptive planner splits).
    """
    now = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    for _ in range(rounds):
        if not mark[0]:
            break
        then = cut_lineage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        new = then.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now, old, mark = then, mark, new
        if tuple(old) == tuple(new):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
