"""Object inventories, ordered sources and head tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import batch_end
from ..functions.keys import PAD_WIDTH, below, parse_batch_dirs, path_parts


def scan_inventory(spark: SparkSession, path: str, prefix: str | None = None, format: str = "parquet") -> DataFrame:
    """Keys and sizes listed under `prefix`.

    `format` is the format of a store inventory table (``parquet``, ``csv``, ``json``,
    ``orc``), or ``binaryFile`` to list the files below `path` themselves. That source
    leaves out empty files, so only an inventory tells "empty" from "absent".
    """
    if format == "binaryFile":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        rows = files.select(below("path", path).alias("key"), F.col("length").alias("size"))
    elif format in ("csv", "json"):
        rows = spark.read.format(format).schema("key string, size bigint").load(path)
    else:
        rows = spark.read.format(format).load(path).select("key", "size")
    return rows.where(F.col("key").startswith(prefix)) if prefix else rows


def with_heights(inventory: DataFrame, width: int = PAD_WIDTH) -> DataFrame:
    """Inventory rows inside height folders, with ``parent, height, member``."""
    parts = inventory.withColumn("_p", path_parts("key", width))
    return parts.select(
        *inventory.columns,
        F.col("_p.parent").alias("parent"),
        F.col("_p.height").alias("height"),
        F.col("_p.member").alias("member"),
    ).where("height is not null")


def read_heights(objects: DataFrame, heights: DataFrame) -> DataFrame:
    """All members of the listed heights."""
    return objects.join(heights.select("height"), "height", "left_semi")


def union_sources(sources: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """One relation out of ordered sources; the lowest priority number is tried first."""
    tagged = [
        df.withColumn("source", F.lit(name)).withColumn("priority", F.lit(priority).cast("int"))
        for name, priority, df in sources
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def height_domain(spark: SparkSession, start: int, stop: int) -> DataFrame:
    """Every height of ``[start, stop]``."""
    return spark.range(start, stop + 1).select(F.col("id").alias("height"))


def expected_batches(spark: SparkSession, start: int, stop: int, size: int) -> DataFrame:
    """Ranges ``[batch_start, batch_end]`` that cover ``[start, stop]``; the last one is clamped."""
    first = F.col("id")
    return spark.range(start, stop + 1, size).select(
        first.alias("batch_start"), F.least(batch_end(first, size), F.lit(stop)).alias("batch_end")
    )


def height_bounds(df: DataFrame, height: str | Column = "height") -> tuple[int, int]:
    """Lowest and highest height of a relation, read as one row. ``(0, -1)`` when empty."""
    height = F.col(height) if isinstance(height, str) else height
    low, high = df.agg(F.min(height), F.max(height)).first()
    return (0, -1) if low is None else (low, high)


def parse_batch_paths(df: DataFrame, name: str = "name") -> DataFrame:
    """Batch folders found by name, with ``first, last``."""
    return parse_batch_dirs(df, name)


def latest_height(df: DataFrame, height: str = "height") -> DataFrame:
    """Head of the chain, one row ``latest``."""
    return df.agg(F.max(height).alias("latest"))


def resume_point(control: DataFrame, start_from: int) -> DataFrame:
    """Next height to process, one row ``next_height``: past the last sealed one, else the start."""
    last = F.max("last_processed_number")
    return control.agg(F.coalesce(last + 1, F.lit(start_from).cast("bigint")).alias("next_height"))
