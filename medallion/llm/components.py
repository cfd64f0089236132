"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import stage


def _linked(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each edge (u, v) with the smallest of u and its neighbours, ``m``.

    The minima are written before the join, so that both sides of it are plain shuffles
    and a node with very many neighbours is split by the skew-join rule."""
    if both_ways:
        edges = edges.union(edges.select(F.col("v"), F.col("u")))
    least = stage(edges.groupBy("u").agg(F.min("v").alias("w")), "least").select(F.col("u").alias("u2"), F.least("u", "w").alias("m"))
    return edges.join(least, F.col("u") == F.col("u2")).select("u", "v", "m")


def large_star(edges: DataFrame) -> DataFrame:
    rows = _linked(edges, True).filter("v > u AND v <> m")
    return rows.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    rows = _linked(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False)
    moved = rows.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(rows.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of longs -> (node, root): the smallest node reachable, for every node with an edge.

    Rounds go on until the set of edges stays the same; the state is a set of edges that
    never grows, written to the shared folder each round. Loops and repeated edges are ignored."""
    state = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        state = stage(small_star(stage(large_star(state), "large")), "small")
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(state.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
