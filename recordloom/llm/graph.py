"""Connected components of large edge tables by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialise, small_side


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame, large: bool, held: list) -> DataFrame:
    """One contraction: neighbours of u move to the least node of u's neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    back = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    pairs = both.unionByName(back) if large else both.where("v <= u").unionByName(back.where("v <= u"))
    # a table of its own, so that the join meets no aggregate and a hub's rows can be dealt to several tasks
    least = materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    held.append(least)
    moved = pairs.join(small_side(least), "u")
    if large:
        return moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    kept = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return kept.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Least node of the component of every node that has an edge: node, component.

    ``edges`` has long columns a and b. Each round writes its edges to the shared
    folder; rounds grow with the logarithm of the longest path, and stop when the
    edges no longer change. Nothing but two numbers a round reaches the driver.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        held = [edges]
        for large in (True, False):
            edges = materialise(_star(edges, large, held), "edges")
            held.append(edges)
        drop(*held[:-1])
        now = _print(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
