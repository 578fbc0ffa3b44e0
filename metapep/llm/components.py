"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_checked


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of the edges (a, b) the least node it is connected with.

    Large and small stars take turns: every node hands its larger neighbours, then all
    of its smaller ones, to the least node it knows.  The number of rounds grows with
    the logarithm of the longest path; a node with many edges only sends its least
    neighbour around, so no neighbourhood is ever gathered in one place.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = join_checked(both.filter("b > a"), least, "a", "inner").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = cut(large)
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        small = join_checked(large, least, "a", "inner").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        if (new := _state(edges)) == state:
            break
        state = new
    own = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.union(own.select(F.col("component").alias("node"), "component")).distinct()
