"""Sizes and counts per height, batch and prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import is_present, megabytes, reduction_pct
from .ranges import assign_batch


def dir_size(objects: DataFrame) -> DataFrame:
    """Bytes per height."""
    return objects.groupBy("height").agg(F.sum("size").alias("bytes"))


def batch_stats(objects: DataFrame, start: int, size: int) -> DataFrame:
    """Directories, files and bytes per batch."""
    # Two steps on (batch, height) and batch: a hot height or batch is combined before each.
    per_height = objects.groupBy("height").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return (
        assign_batch(per_height, start, size)
        .groupBy("batch_start", "batch_end")
        .agg(F.count("*").alias("dirs"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    )


def size_metrics(df: DataFrame, uncompressed: str = "uncompressed", compressed: str = "compressed") -> DataFrame:
    """Adds ``uncompressed_mb, compressed_mb, reduction_pct``."""
    return df.select(
        "*",
        megabytes(uncompressed).alias("uncompressed_mb"),
        megabytes(compressed).alias("compressed_mb"),
        reduction_pct(uncompressed, compressed).alias("reduction_pct"),
    )


def fetch_stats(source: DataFrame, local: DataFrame) -> DataFrame:
    """Files and bytes fetched and skipped per height; skipped files count their local size."""
    held = local.where(is_present("size")).groupBy("height", "member").agg(F.max("size").alias("held"))
    skip = F.col("held").isNotNull()
    return (
        source.join(held, ["height", "member"], "left")
        .groupBy("height")
        .agg(
            F.count_if(~skip).alias("files_fetched"),
            F.count_if(skip).alias("files_skipped"),
            F.sum(F.when(skip, F.lit(0)).otherwise(F.col("size"))).alias("bytes_fetched"),
            F.sum(F.when(skip, F.col("held")).otherwise(F.lit(0))).alias("bytes_skipped"),
        )
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Objects and bytes per ``prefix``, plus a total row with a null prefix."""
    # Summed per prefix first, so that the rollup only sees one row per prefix.
    per_prefix = inventory.groupBy("prefix").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))
    return per_prefix.rollup("prefix").agg(F.sum("objects").alias("objects"), F.sum("bytes").alias("bytes"))


def common_prefixes(inventory: DataFrame, prefix: str, delimiter: str = "/") -> DataFrame:
    """Folders one level below `prefix`, each with its trailing delimiter."""
    rest = F.substring(F.col("key"), len(prefix) + 1, 2**31 - 1)
    inside = inventory.where(F.col("key").startswith(prefix)).where(F.instr(rest, delimiter) > 0)
    return inside.select(
        F.concat(F.lit(prefix), F.substring_index(rest, delimiter, 1), F.lit(delimiter)).alias("prefix")
    ).distinct()
