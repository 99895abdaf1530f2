"""Connected components of links that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake.session import stage


def _reduced(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest in its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.filter("b > a").join(least, "a")
    return _reduced(moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _reduced(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node but the smallest of its component, with the smallest.

    Large and small stars alternate until nothing changes, which takes about as
    many rounds as the logarithm of the longest path. Each round is written to
    the shared folder. Neighbourhoods are reduced by aggregates and joins, so a
    node with very many links is no single task's work. No edges give no rows.
    """
    edges = stage(_reduced(edges.select("a", "b")), "links")
    last = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "stars")
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == last:
            return edges
        last = mark
