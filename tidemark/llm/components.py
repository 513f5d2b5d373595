"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(pairs: DataFrame) -> DataFrame:
    """The least neighbour, or itself, of each ``a``: pre-aggregated, so a node of any degree is no burden."""
    return pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


#: Parts that the edges of one node are dealt into where they meet its least neighbour.
SALTS = 16


def _with_least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the least neighbour m of ``a``; a hub's edges are dealt to several tasks."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    least = _least(pairs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(least, ["a", "salt"]).select("a", "b", "m")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (a, b). Loops and repeated edges are allowed.

    Each round ends in a written table, so a lost executor costs one round at most. No node's neighbours are ever
    gathered: a round joins each edge with the least neighbour of its end.
    """
    spark = edges.sparkSession
    edges = common.cut(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        both = _mirrored(edges)
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = common.cut(large.filter("a <> b").distinct(), "large")
        # Small star: each node's smaller neighbours, and itself, hang on the least of them.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        small = common.cut(small.filter("a <> b").distinct(), "small")
        # Done when every edge points from a node to a root: no node is both, and none has two roots.
        nodes = small.groupBy("a").agg(F.count("*").alias("n"))
        roots = small.select(F.col("b").alias("a")).distinct()
        done = nodes.join(roots, "a", "left_semi").select("a").unionAll(nodes.filter("n > 1").select("a")).isEmpty()
        for old in (edges, large):
            common.drop_table(spark, old)
        edges = small
        if done:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``found`` (node, component), joined by the edges ``more`` (a, b), which may bring new nodes.

    Only the components are nodes of the graph that is left, and if no edge leads from one to another nothing is left to do.
    """
    spark = found.sparkSession
    of = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"{name}_in"))
    both = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
    both = common.cut(both.filter("a <> b").distinct(), "between")
    if both.isEmpty():
        common.drop_table(spark, both)
        return found
    wider = common.cut(components(both), "wider")
    common.drop_table(spark, both)
    old = found.join(wider.select(F.col("node").alias("component"), F.col("component").alias("wider")), "component", "left")
    new = wider.join(found.select("node"), "node", "left_anti")
    return old.select("node", F.coalesce("wider", "component").alias("component")).unionAll(new.select("node", "component"))
