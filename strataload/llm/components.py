"""Connected components by alternating stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node move to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge (a, b); the label is the component's smallest node."""
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "component-edges",
    )
    seal = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    before = current.select(seal).first()[0]
    while True:
        current = materialize(_small_star(_large_star(current)), "component-edges")
        after = current.select(seal).first()[0]
        if after == before:
            break
        before = after
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
