"""Connected components of a link table by alternating star contraction.

Each round applies a large-star step (every neighbour above a node is linked
to the smallest neighbour) and a small-star step (the neighbours below are),
until the links form stars; the number of rounds grows with the logarithm of
the longest path.  Minima are taken by partial aggregation and links of one
node are never gathered, so that no node's degree bounds a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node that has a link to another node, the
    smallest node reachable from it.  ``links`` may repeat or name a pair in
    either order; links of a node to itself or to null are left out."""
    edges = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: m = the smallest of a node and its neighbours
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: the neighbours below a node move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = cut_lineage(large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u > v").distinct())
        now = _state(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v"), F.col("v")).distinct())
