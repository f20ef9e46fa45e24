"""Connected components of links between whole numbers, by alternating large-star and small-star steps on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqlake.llm.common import release, stage


def is_stars(links: DataFrame) -> bool:
    """Whether every node links to one smaller node, and that to none."""
    repeated = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    inner = links.select(F.col("b").alias("a")).join(links.select("a"), "a", "left_semi")
    return repeated.union(inner).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs) that is not the smallest of its component.

    Links may repeat, point either way or to themselves. Each step stores the least neighbour of every node before it meets the
    links, so Spark knows its size and can split a node that a third of all links touch. Steps end when all links are stars.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(ends.filter("a <> b").distinct(), "links")
    while not is_stars(now):
        both = now.union(now.select("b", "a"))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stage(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "links")
        release(now, least)
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = stage(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        release(large, least)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
