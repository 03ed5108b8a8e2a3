"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import shared_table


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node with an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type. Each round
    makes every node point at smaller neighbours and is written to the shared
    folder, so a lost executor costs one round. The number of rounds grows with
    the logarithm of the longest chain. A hub's edges are split by AQE's skewed
    join; its minimum is pre-aggregated.
    """
    e = shared_table(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = _state(e)
    if not before[0]:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        e = shared_table(_small_star(_large_star(e)), "edges")
        now = _state(e)
        if now == before:
            roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        before = now
    raise RuntimeError("components did not converge")
