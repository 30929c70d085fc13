"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdmflow.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours and the node itself are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    pairs = down.join(least, "a")
    return (pairs.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(pairs.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of an edge, ``root`` the least node of its component.

    Each round is staged in the shared folder, so a lost executor repeats one round at most. The rounds
    grow with the logarithm of the largest component's width. Sums are taken before shuffling; the joins
    are on a node, and a node with very many edges is split by adaptive skew handling. Self-loops and
    repeated edges do no harm; null ends are dropped (they name no node).
    """
    current = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna(), "edges")
    before = _mark(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), "star")
        now = _mark(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
