"""Connected components by alternating stars, with each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.plans.staging import stage

ROUNDS = 64  # far more than any graph needs: the rounds grow with the logarithm of its size


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that an edge names; the smallest node names it.

    Edges are pairs of long numbers; loops, repeated edges and either order are fine. A
    node with very many edges is joined by splitting its rows (adaptive execution); its
    smallest neighbour is found by partial aggregation.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    now = stage(pairs.distinct(), "edges")
    mark = _mark(now)
    for _ in range(ROUNDS):
        now = stage(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    named = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return named.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.where(F.col("u") != F.col("v")).unionByName(own).distinct()
