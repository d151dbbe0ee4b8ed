"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import common


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest node of each node's component: columns node and root, for nodes with an edge.

    Edges are (a, b). Each round hangs a node's smaller neighbours, then its larger ones,
    below the smallest of them, until the edges are stars around the smallest nodes; that
    takes about log(n) rounds. Each round is stored, so lost executors cost one round,
    and edges are rows throughout: no node's neighbours meet in one place.
    """
    star = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    star = common.stored(star.distinct(), "edges")
    for _ in range(rounds):
        least = star.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        hung = star.join(least, star.a == least.u).select(star.b.alias("a"), F.col("m").alias("b"))
        small = hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        small = common.stored(small.where("a <> b").distinct(), "edges")
        both = small.union(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = small.join(least, small.b == least.u).select(small.a, F.col("m").alias("b"))
        star = common.stored(large.distinct(), "edges")
        if _settled(star):
            break
    else:
        raise RuntimeError("the components did not settle")
    leaves = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = star.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return leaves.union(roots).distinct()


def _settled(star: DataFrame) -> bool:
    """Whether each node hangs below one node at most, and none hangs below a hanging one."""
    ends = star.selectExpr("a as node", "1 as hangs", "0 as holds").union(
        star.selectExpr("b as node", "0 as hangs", "1 as holds")
    )
    seen = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return seen.where("hangs + holds > 1").isEmpty()
