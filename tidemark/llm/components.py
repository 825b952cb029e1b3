"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


SMALL_EDGES = 100_000  # a graph of so few edges is stepped through without shuffles


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable from each node that has an edge.

    Edges are undirected; loops, repeats and nulls do no harm.  Each step is a grouped minimum and
    a join, both of which Spark can spread however many neighbours a node has; every
    step is written to the shared folder.  Once few edges are left, they share a partition.  The number of steps follows the logarithm of
    the longest path.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    kept, mark = _settled(edges)
    few = mark[0] <= SMALL_EDGES
    if few:  # in one file, for the steps read it several times
        first, kept = kept, stored(kept.coalesce(1), "edges")
        discard(first)
    while True:
        before, edges = mark, kept.coalesce(1) if few else kept
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        last = kept
        kept, mark = _settled((small.coalesce(1) if few else small).where("u <> v").distinct())
        discard(last)
        if mark == before:
            break
    edges = kept.coalesce(1) if few else kept
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = stored(edges, "edges")
    mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    return edges, mark
