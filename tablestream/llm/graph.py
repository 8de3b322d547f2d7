"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    Alternating large-star and small-star steps until the edges no longer change.  Neighbourhoods are
    only ever reduced to their minimum before a shuffle, never gathered; each step's edges are
    written to the shared folder, which ends lineage.  Joins are between stored tables, so Spark can
    split a hub's edges.
    """
    edges = stored(_down(edges.select("a", "b")), "edges")
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count("*").alias("n"), F.sum((F.xxhash64("a", "b") % (1 << 40)).cast("decimal(20,0)")).alias("s")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = stored(_down(large), "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        pairs = large.join(least, "a")
        small = pairs.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(_down(small.unionAll(least.select("a", F.col("m").alias("b")))), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return (edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct())
