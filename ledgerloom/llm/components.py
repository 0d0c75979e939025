"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node are linked to its smallest neighbour or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .unionAll(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of `links` (``a, b``) that aren't the smallest of theirs.

    Stars are merged until nothing changes, in a number of rounds that grows with the logarithm
    of the links. Every round is stored, and hubs are joined, never gathered.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "components")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(seen)
