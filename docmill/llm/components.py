"""Connected components of a graph whose edges are a table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.tables import Stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(edges: DataFrame, most: int = 60) -> Stored:
    """(node, label) for every node of the edges (a, b): the least node of its component.

    Each round points the larger neighbours of every node at its least neighbour, then the smaller ones; the number of
    rounds grows with the logarithm of the longest path. All state is in tables, of which one round back is kept.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    held = Stored(pairs)
    before = None
    for _ in range(most):
        both = held.df.unionByName(held.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        new = Stored(small.where("a <> b").distinct())
        now = _state(new.df)
        held.drop()
        held = new
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    labels = held.df.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = Stored(labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct()))
    held.drop()
    return out
