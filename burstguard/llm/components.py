"""Connected components by alternating star operations, in DataFrame operations only (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstguard.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("m").alias("b"), F.col("b").alias("a")).select("a", "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them. ``a > b`` in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node on some edge ``a, b``: the smallest node of its component.

    Loops and repeated edges do no harm; null ends are dropped. Each round is a written table; rounds end when the
    edges no longer change, after about the logarithm of the longest path. Hot nodes are joined against one row per
    node, so that adaptive execution can split them.
    """
    current = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        # an exact test: stars have one edge per node, and no centre is another one's leaf
        one = current.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        many = one.filter("n > 1").isEmpty()
        if many and current.join(current.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before, current = current, written(_small_star(_large_star(current)))
        discard(before)
