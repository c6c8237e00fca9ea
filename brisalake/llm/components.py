"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisalake.llm.common import Stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to a node's smallest neighbour: the larger ones (large star) or the smaller ones and itself."""
    both = edges.union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = both.join(least, "a")
    if large:
        out = linked.filter("b > a").select("b", "m")
    else:
        out = linked.select("b", "m").union(least.select(F.col("a").alias("b"), "m"))
    return out.filter("b <> m").toDF("a", "b").distinct()


def components(stage: Stage, edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node reachable.

    Alternating stars: after about the square of the logarithm of the nodes' number
    every edge points to its root. Each round is stored, and deleted when the one
    after it is; only two numbers reach the driver.
    """
    now = stage.store(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-0")
    seen, i = None, 0
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.toDF("node", "root")
        if i:
            stage.drop(f"{name}-{i - 1}")
        seen, i = mark, i + 1
        now = stage.store(_star(_star(now, True), False), f"{name}-{i}")
