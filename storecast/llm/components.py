"""Connected components of a graph of 64-bit nodes, by rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest; equal marks of two rounds end the search."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the smallest node reachable. Roots themselves are left out.

    Each round is written to the shared folder, so no plan grows and a lost executor costs one round at most. The
    neighbours of a popular node combine before the shuffle; its own join may be split, as the other side is unique.
    No edges: no rows. Loops and repeated edges change nothing.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
