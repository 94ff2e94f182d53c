"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.plans.sizing import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); the component
    is its smallest node.

    Large-star and small-star rounds until nothing changes: each round
    replaces edges by edges to the smallest neighbour, so no node's list is
    ever gathered, groups shrink to stars in a logarithmic number of rounds,
    and the smallest neighbour is a partial aggregate.
    """
    left = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(left.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        # Small star: a node's smaller neighbours, and itself, join the smallest of them.
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(small_least, "b")
        small = joined.select(F.col("m").alias("a"), "b").unionByName(joined.select(F.col("m").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
        new = stored(small, "edges")
        # Stars: every node has one smaller neighbour, which has none.
        if _same(left, new):
            break
        left = new
    return new.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        new.select(F.col("a").alias("node"), F.col("a").alias("component"))
    ).distinct()


def _same(a: DataFrame, b: DataFrame) -> bool:
    def sums(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    return sums(a) == sums(b)
