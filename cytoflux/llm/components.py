"""Connected components of a graph of links, as Spark joins over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 40))).alias("s")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) to one row per linked node: ``node`` and ``component``, its least reachable node.

    Alternates large-star and small-star steps; a step sends each edge to the least neighbour of
    one of its ends, and the number of steps grows with the logarithm of the longest path.  Each
    step's edges are written to the shared folder.  The minimum of a node is found before the join, with
    partial sums per task, and joins are between plain tables, which Spark splits where a
    node has very many edges.  Nulls and self-links are left out.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
