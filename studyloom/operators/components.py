"""Connected components by alternating large-star and small-star rounds.

Every round is a fixed number of joins on node keys, each round's edges are staged, and the edge table never grows
beyond the nodes and edges it began with. The number of rounds grows with the logarithm of a component's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.storage import staged

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return r.n, r.h


def _with_min(edges: DataFrame) -> DataFrame:
    """edges(a, b) with m, the smallest of a and its b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least.select("a", F.least("a", "m").alias("m")), "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of one orderable type -> node, component: the smallest node that it reaches.

    Loops and repeated edges change nothing; an edge with a null end is ignored; nodes without an edge do not
    appear; an empty edge table gives an empty result."""
    edges = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "components")
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_min(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        small = _with_min(large)
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = staged(small.select("e.*").where(F.col("a") != F.col("b")).distinct(), "components")
        if (now := _mark(edges)) == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
