"""Connected components of a distributed list of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import stage


def _mark(links: DataFrame) -> tuple:
    """Number and digest of the links: equal when a step changed nothing."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least node it knows."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least")
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the least of them."""
    least = stage(links.groupBy("a").agg(F.min("b").alias("low")), "least")
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = least.select("a", F.col("low").alias("b"))
    return moved.union(own).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of `links` (a, b) with the least node of its component.

    The number of steps grows with the logarithm of the longest path. Links and the least
    neighbours are written out before they are joined: between two plain shuffles Spark can split
    the links of a node that has a large part of them. Links are longs; those
    of a node with itself and repeated ones may be given.
    """
    pair = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stars = stage(pair.distinct(), "stars")
    mark = _mark(stars)
    while mark[0]:
        stars = stage(_small_star(stage(_large_star(stars), "large-stars")), "stars")
        before, mark = mark, _mark(stars)
        if before == mark:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
