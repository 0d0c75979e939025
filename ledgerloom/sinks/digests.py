"""Digests of batches that do not depend on the order of rows, down to the height.

A digest is the exact sum of the 64-bit hashes of all rows, as a decimal, so equal rows count as
often as they occur. Digests of heights add up to those of nodes of `FAN` heights, these to the
ones above, the last to that of the batch: a tree by arithmetic. Two trees are compared from the
top, and only below nodes that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import whole_div

PARTITION = ["batch_start", "batch_end"]

# Children per node.
FAN = 256

# Levels of nodes; the top of a batch is FAN ** LEVELS heights wide, and wider ones have several.
LEVELS = 3

_SUM = "decimal(38,0)"


def digest(df: DataFrame, where: Column | None = None) -> Column:
    """Aggregate over the rows of `df`, or those `where` holds for, without the columns of the batch."""
    columns = sorted(c for c in df.columns if c not in PARTITION)
    hashed = F.xxhash64(*columns).cast("decimal(20,0)")
    hashed = hashed if where is None else F.when(where, hashed)
    return F.coalesce(F.sum(hashed).cast(_SUM), F.lit(0).cast(_SUM))


def height_digests(rows: DataFrame) -> DataFrame:
    """``batch_start, batch_end, height`` with ``files, digest`` of the rows of each height."""
    return rows.groupBy(*PARTITION, "height").agg(F.count(F.lit(1)).alias("files"), digest(rows).alias("digest"))


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of `level` out of those below, whose ``node`` is a height or a node number."""
    parent = whole_div("node", F.lit(FAN)).alias("node")
    added = nodes.groupBy(*PARTITION, parent).agg(
        F.sum("files").cast("bigint").alias("files"), F.sum("digest").cast(_SUM).alias("digest")
    )
    return added.withColumn("level", F.lit(level))


def digest_tree(leaves: DataFrame) -> DataFrame:
    """All nodes: ``level, batch_start, batch_end, node, files, digest``; level 0 has the heights.

    Nodes are numbered from the start of their batch, so batches of any size have the same shape.
    """
    below = leaves.select(
        *PARTITION, (F.col("height") - F.col("batch_start")).alias("node"), "files", "digest"
    ).withColumn("level", F.lit(0))
    levels = [below]
    for level in range(1, LEVELS + 1):
        levels.append(_above(levels[-1], level))
    return reduce(DataFrame.unionByName, levels).select("level", *PARTITION, "node", "files", "digest")


def write_tree(leaves: DataFrame, path: str) -> None:
    """Keep a tree by level, so that a comparison reads the upper levels alone unless they differ."""
    digest_tree(leaves).write.mode("overwrite").partitionBy("level").parquet(path)


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _differing(wanted: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    theirs = found.select(*on, F.col("files").alias("_files"), F.col("digest").alias("_digest"))
    same = F.col("files").eqNullSafe(F.col("_files")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return wanted.select(*on, "files", "digest").join(theirs, on, "full").where(~same)


def damaged_in_trees(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Heights that differ between two written trees, as :func:`damaged_heights` gives them.

    Each level below the top is read only for children of nodes that differ; where no top
    differs, nothing else is looked at.
    """
    on = [*PARTITION, "node"]
    suspects = None
    for level in range(LEVELS, -1, -1):
        sides = [tree.where(F.col("level") == level) for tree in (wanted, found)]
        if suspects is not None:
            parents = suspects.select(*PARTITION, F.col("node").alias("_parent"))
            keyed = [side.withColumn("_parent", whole_div("node", F.lit(FAN))) for side in sides]
            sides = [side.join(parents, [*PARTITION, "_parent"], "left_semi") for side in keyed]
        suspects = _differing(*sides, on)
    return _named(suspects.withColumn("height", F.col("batch_start") + F.col("node")))


def damaged_heights(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """``batch_start, batch_end, height, files, stored_files, verdict`` where digests of heights differ.

    Verdicts: ``missing`` (nothing stored), ``extra`` (nothing went in), ``changed``.
    """
    return _named(_differing(wanted, found, [*PARTITION, "height"]))


def _named(differing: DataFrame) -> DataFrame:
    verdict = F.when(F.col("_files").isNull(), "missing").when(F.col("files").isNull(), "extra").otherwise("changed")
    zero = F.lit(0).cast("bigint")
    return differing.select(
        *PARTITION,
        "height",
        F.coalesce("files", zero).alias("files"),
        F.coalesce("_files", zero).alias("stored_files"),
        verdict.alias("verdict"),
    )
