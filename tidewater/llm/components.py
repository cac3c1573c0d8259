"""Connected components of an undirected graph given as a table of edges.

Alternates large-star and small-star steps: each vertex links its larger
neighbours (then its smaller ones) to the smallest vertex it knows, until every
edge points at the smallest vertex of its component.  The rounds grow with the
logarithm of the graph's size.  A vertex's neighbours are never gathered: the
smallest is a (pre-aggregated) minimum, and comes back to the edges by a join
that Spark can split at a hot vertex.  Each round is written to shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """edges (a > b): every neighbour of a vertex that is larger than it links to the smallest known there."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """edges (a > b): a vertex and its smaller neighbours link to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """vertex, root: the smallest vertex of its component, for every vertex with an edge that is not the root itself.

    ``edges``: a, b (comparable values, in any order; loops and repeated
    edges are allowed).  An empty table gives an empty result.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = scratch(ordered.distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = scratch(_small_star(_large_star(now).distinct()).distinct(), "edges")
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == (row["n"], row["h"]):
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        mark = (row["n"], row["h"])
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
