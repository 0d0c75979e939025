"""Batches and archives as closed ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.checks import batch_end, batch_start, in_scope, whole_div
from ..functions.keys import archive_key, range_name
from .common import slice_width


# Heights a task makes of one row.
CHUNK = 10_000


def assign_batch(df: DataFrame, start: int, size: int) -> DataFrame:
    """Adds ``batch_start, batch_end`` by arithmetic; bins never move with the end of the data."""
    first = batch_start("height", start, size)
    return df.withColumn("batch_start", first).withColumn("batch_end", batch_end("batch_start", size))


def batch_heights(batches: DataFrame) -> DataFrame:
    """Every height of each batch (``batch_start, batch_end``), one row each.

    Batches are cut into chunks that are dealt out first, so a few long batches, or a small
    table of many, are the work of as many tasks as any shuffle.
    """
    partitions = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = F.lit(CHUNK).cast("bigint")
    chunks = batches.select("*", F.explode(F.sequence("batch_start", "batch_end", step)).alias("_low"))
    dealt = chunks.repartition(partitions, "batch_start", "batch_end", "_low")
    high = F.least(F.col("_low") + (CHUNK - 1), F.col("batch_end"))
    return dealt.select(*batches.columns, F.explode(F.sequence(F.col("_low"), high)).alias("height"))


def scope_filter(archives: DataFrame, start: int, stop: int | None) -> DataFrame:
    """Archives that overlap ``[start, stop]``."""
    return archives.where(in_scope("first", "last", start, stop))


def missing_ranges(expected: DataFrame, archives: DataFrame) -> DataFrame:
    """Expected ranges no archive has exactly, as ``first, last``."""
    wanted = expected.select(F.col("batch_start").alias("first"), F.col("batch_end").alias("last"))
    return wanted.join(archives.select("first", "last").distinct(), ["first", "last"], "left_anti")


def pending_batches(expected: DataFrame, inventory: DataFrame, prefix: str = "archives", codec: str = "zstd") -> DataFrame:
    """Expected batches whose archive key is not in the inventory."""
    keyed = expected.withColumn("key", archive_key("batch_start", "batch_end", prefix, codec))
    return keyed.join(inventory.select("key"), "key", "left_anti").select("batch_start", "batch_end", "key")


def first_archive(archives: DataFrame) -> DataFrame:
    """One archive per range, the first in listing order."""
    return archives.groupBy("first", "last").agg(F.min("key").alias("key"))


def duplicate_archives(archives: DataFrame) -> DataFrame:
    """Archives that share their range with another one, with the number of copies."""
    shared = archives.groupBy("first", "last").agg(F.count("*").alias("copies")).where("copies > 1")
    return archives.select("first", "last", "key").join(shared, ["first", "last"])


def ordered_archives(archives: DataFrame) -> DataFrame:
    """Archives by range."""
    return archives.orderBy("first", "last", "key")


def top_missing(missing: DataFrame, n: int = 50) -> DataFrame:
    """The first `n` missing ranges."""
    return missing.orderBy("first", "last").limit(n)


def validation_summary(expected: DataFrame, missing: DataFrame, n: int = 50) -> DataFrame:
    """One row: expected and missing ranges, and the names of the first `n` missing ones."""
    # At most n rows reach the list.
    listed = top_missing(missing, n).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("first", "last"))), lambda r: range_name(r["first"], r["last"])),
            ",",
        )
    )
    return expected.agg(F.count("*").alias("expected")).select(
        "expected",
        missing.agg(F.count("*")).scalar().alias("missing"),
        listed.scalar().alias("first_missing"),
    )


def coverage(archives: DataFrame, start: int, stop: int) -> DataFrame:
    """Stretches of ``[start, stop]`` not covered by exactly one archive.

    ``kind`` is ``gap`` (depth 0) or ``overlap`` (depth 2 and more); stretches of different
    depth are separate rows. Range starts and ends become steps up and down, summed per
    height before the shuffle, so many archives of one range are one step. The running
    depth is built per height slice and shifted by the totals of earlier slices.
    """
    width = slice_width(start, stop)
    scoped = archives.where(in_scope("first", "last", start, None) & (F.col("first") <= stop))
    low = F.greatest(F.col("first"), F.lit(start))
    high = F.least(F.col("last"), F.lit(stop)) + 1
    steps = scoped.select(
        F.explode(
            F.array(
                F.struct(low.alias("height"), F.lit(1).cast("bigint").alias("step")),
                F.struct(high.alias("height"), F.lit(-1).cast("bigint").alias("step")),
            )
        ).alias("s")
    ).select("s.*")
    spark = archives.sparkSession
    ends = spark.range(2).select(
        F.when(F.col("id") == 0, F.lit(start)).otherwise(F.lit(stop + 1)).cast("bigint").alias("height"),
        F.lit(0).cast("bigint").alias("step"),
    )
    points = (
        steps.unionByName(ends)
        .groupBy("height")
        .agg(F.sum("step").alias("step"))
        .where((F.col("step") != 0) | F.col("height").isin(start, stop + 1))
        .withColumn("_slice", whole_div(F.col("height") - start, F.lit(width)))
    )
    # At most MAX_SLICES + 1 rows from here on.
    in_order = Window.partitionBy(F.lit(0)).orderBy("_slice")
    slices = (
        points.groupBy("_slice")
        .agg(F.sum("step").alias("_total"), F.min("height").alias("_first"))
        .select(
            "_slice",
            F.coalesce(
                F.sum("_total").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
            F.lead("_first").over(in_order).alias("_next"),
        )
    )
    within = Window.partitionBy("_slice").orderBy("height")
    depth = F.col("_offset") + F.sum("step").over(within)
    return (
        points.join(F.broadcast(slices), "_slice")
        .select(
            F.col("height").alias("first"),
            (F.coalesce(F.lead("height").over(within), F.col("_next")) - 1).alias("last"),
            depth.cast("bigint").alias("depth"),
        )
        .where((F.col("last") >= F.col("first")) & (F.col("depth") != 1))
        .select(F.when(F.col("depth") == 0, "gap").otherwise("overlap").alias("kind"), "first", "last", "depth")
    )
