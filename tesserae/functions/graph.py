"""Connected components by alternating large-star and small-star joins (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.functions.storage import cut, discard


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each ``u``, itself included."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = both.join(_least(both), "u")
    return found.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    found = down.join(least, "u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of every node that has an edge.

    ``edges`` has two comparable columns ``u`` and ``v``; loops are ignored and order within a pair is free.
    Returns ``node, component`` where the component is the smallest node reached. Each round is written to the
    shared folder and the one before it is emptied; the number of rounds grows with the logarithm of the longest path.
    """
    now = cut(edges.where("u <> v").distinct())
    mark = None
    for _ in range(max_rounds):
        before, now = now, cut(_small_star(_large_star(now).distinct()).where("u <> v").distinct())
        discard([before])
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
