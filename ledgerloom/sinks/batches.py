"""Range batches as partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions.keys import archive_key
from ..operators.common import broadcast_within, of_batches
from ..operators.ranges import assign_batch
from ..session import discard, exists, materialise
from .digests import PARTITION, damaged_heights, digest, height_digests
from .groups import GROUP, folders, group_width, grouped, stored_width

# Tells rows that go in from those that only move along with their group.
_NEW = "_new"


def balanced(df: DataFrame, width: int = 0) -> DataFrame:
    """Rows put together by folder for writing; AQE splits folders that are too big for one task."""
    return df.hint("rebalance", folders(width)[0])


def stored_order(df: DataFrame, width: int = 0) -> DataFrame:
    """Blocks by height, then all other members by height and name, batch after batch.

    With the blocks in pages of their own, a scan for headers skips the payload of the shards.
    """
    rest = F.col("member") != "block.json"
    return df.sortWithinPartitions(*(GROUP if width else ()), *PARTITION, rest, "height", "member")


def totals(df: DataFrame, where: Column | None = None) -> dict:
    size = F.col("size") if where is None else F.when(where, F.col("size"))
    return {
        "files": F.count(F.lit(1)) if where is None else F.count_if(where),
        "bytes": F.coalesce(F.sum(size), F.lit(0)),
        "digest": digest(df, where),
    }


def binned(df: DataFrame, start: int, size: int) -> DataFrame:
    """Adds the batch by arithmetic unless the rows already say which one they belong to."""
    return df if set(PARTITION) <= set(df.columns) else assign_batch(df, start, size)


def _write(
    df: DataFrame,
    path: str,
    mode: str,
    codec: str,
    level: int | None = None,
    *,
    ordered: bool = True,
    batches: DataFrame | None = None,
) -> dict:
    """Write `df` by folder. `batches` lists at least the batches of `df`, where that is cheaper to count."""
    spark, scratch, rows, new = df.sparkSession, [], df, None
    width = None if mode == "static" else stored_width(spark, path)
    if width and mode == "dynamic":
        rows, new = _with_neighbours(df, path, width, scratch), F.col(_NEW)
    if width is None:  # a new table
        width = group_width(df if batches is None else batches)
    rows = balanced(grouped(rows, width), width)
    # Counted in the stage that writes, so what went in is known without a second run.
    seen = Observation()
    rows = (stored_order(rows, width) if ordered else rows).observe(
        seen, *(c.alias(name) for name, c in totals(df, new).items())
    )
    writer = (
        rows.drop(_NEW).write.mode("append" if mode == "append" else "overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static")
        .option("compression", codec)
    )
    if level is not None and codec == "zstd":
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.partitionBy(*folders(width)).parquet(path)
    for part in scratch:
        discard(spark, part)
    return seen.get


def _with_neighbours(df: DataFrame, path: str, width: int, scratch: list[str]) -> DataFrame:
    """`df` with the other stored batches of its groups, so that whole groups can be overwritten."""
    spark = df.sparkSession
    fresh = materialise(df.select(*PARTITION).distinct(), "fresh", scratch)
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    touched = materialise(grouped(fresh, width).select("range_start").distinct(), "touched", scratch)
    kept = stored.join(broadcast_within(touched), "range_start", "left_semi").drop(*GROUP)
    kept = kept.join(broadcast_within(fresh), PARTITION, "left_anti")
    return df.withColumn(_NEW, F.lit(True)).unionByName(kept.withColumn(_NEW, F.lit(False)), allowMissingColumns=True)


def write_batches(
    df: DataFrame, path: str, start: int = 0, size: int = 1, codec: str = "zstd", level: int | None = None
) -> dict:
    """Compact objects (``height, member, size, …``) into one partition per batch.

    Each file is in :func:`stored_order`. A small batch is one file, a hot one several; very many
    batches share folders, see :mod:`groups`. Returns the files, bytes and digest that went in, for
    :func:`verify_totals`.
    """
    return _write(binned(df, start, size), path, "static", codec, level)


def replace_batches(
    df: DataFrame,
    path: str,
    start: int = 0,
    size: int = 1,
    codec: str = "zstd",
    level: int | None = None,
    batches: DataFrame | None = None,
) -> dict:
    """Overwrite only the batches that occur in `df`; the others stay as they are.

    `df` must not read from `path`: write repaired rows to a staging path first. `batches` may
    list the batches of `df`, or more, for a table that does not exist yet.
    """
    return _write(binned(df, start, size), path, "dynamic", codec, level, batches=batches)


def write_heights(df: DataFrame, path: str, start: int = 0, size: int = 1, append: bool = False) -> dict:
    """Keep batches uncompressed, in arrival order, for later work; `append` adds to stored ones."""
    return _write(binned(df, start, size), path, "append" if append else "static", "none", ordered=False)


def merge_heights(df: DataFrame, path: str, start: int = 0, size: int = 1) -> dict:
    """Add rows to an uncompressed batch table in place of those of the same height and member.

    The batches concerned are put together beside the table first, then replaced.
    """
    spark, scratch = df.sparkSession, []
    rows = materialise(binned(df, start, size), "merged", scratch)
    if exists(spark, path):
        touched = rows.select(*PARTITION).distinct()
        old = of_batches(read_batches(spark, path, rows.schema), touched)
        kept = old.join(rows.select(*PARTITION, "height", "member").distinct(), [*PARTITION, "height", "member"], "left_anti")
        rows = materialise(kept.unionByName(rows), "merged", scratch)
    totals_in = _write(rows, path, "dynamic", "none", ordered=False)
    for part in scratch:
        discard(spark, part)
    return totals_in


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Written batches. Filters on ``batch_start`` and ``batch_end`` prune folders.

    With a `schema`, a table without any batch yet can be read, too.
    """
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    kept = [c for c in rows.columns if c not in (*PARTITION, *GROUP)]
    return rows.select(*kept, *(F.col(c).cast("bigint").alias(c) for c in PARTITION))


def batch_inventory(
    spark: SparkSession,
    path: str,
    prefix: str = "archives",
    codec: str = "zstd",
    between: tuple[int, int] | None = None,
) -> DataFrame:
    """A batch table as an archive inventory: ``key, size, batch_start, batch_end``.

    Made from the file listing alone, so that stored batches can be validated, or left out of
    the pending ones, like archives. `between` bounds the batch starts. Batches that share files
    come from the columns of their batch; each has its share of a file, by the bytes of its members.
    """
    if stored_width(spark, path):
        files = _shares(spark.read.parquet(path))
    else:
        files = spark.read.format("binaryFile").load(path)
    if between:
        files = files.where(F.col("batch_start").between(*between))
    keys = [F.col(c).cast("bigint").alias(c) for c in PARTITION]
    return files.groupBy(*keys).agg(F.sum("length").alias("size")).select(
        archive_key("batch_start", "batch_end", prefix, codec).alias("key"), "size", *PARTITION
    )


def _shares(rows: DataFrame) -> DataFrame:
    """``batch_start, batch_end, length`` per file and batch; the lengths of a file add up to its own."""
    weight = F.sum(F.coalesce("size", F.lit(0)) + 1)
    file = ["_file", "_bytes"]
    meta = rows.select(
        *PARTITION, "size", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")
    )
    held = meta.groupBy(*file, *PARTITION).agg(weight.alias("_weight"))
    order = Window.partitionBy(*file).orderBy(*PARTITION)
    whole = F.sum("_weight").over(Window.partitionBy(*file))

    def edge(weights: Column) -> Column:
        return F.floor(F.col("_bytes") * (weights / whole)).cast("bigint")

    upto = F.sum("_weight").over(order)
    return held.select(*PARTITION, (edge(upto) - edge(upto - F.col("_weight"))).alias("length"))


def verify_totals(stored: DataFrame, went_in: dict) -> bool:
    """Whether stored rows, read back whole, hold the files, bytes and digest that went in."""
    back = stored.drop(*PARTITION)
    row = back.agg(*(c.alias(name) for name, c in totals(back).items())).first()
    return row.asDict() == went_in


def require_totals(stored: DataFrame, went_in: dict, path: str) -> None:
    """Raise unless :func:`verify_totals` holds."""
    if not verify_totals(stored, went_in):
        raise RuntimeError(f"{path} does not hold what was written to it")


def _fingerprint(df: DataFrame) -> DataFrame:
    return df.groupBy(*PARTITION).agg(*(c.alias(name) for name, c in totals(df).items()))


def verify_batches(source: DataFrame, path: str, start: int, size: int) -> DataFrame:
    """Verdict per batch: does the written copy hold what went in? Reads every column back."""
    wanted = _fingerprint(assign_batch(source, start, size))
    stored = _fingerprint(read_batches(source.sparkSession, path).select(*source.columns, *PARTITION))
    same = (
        F.col("files").eqNullSafe(F.col("stored_files"))
        & F.col("bytes").eqNullSafe(F.col("stored_bytes"))
        & F.col("digest").eqNullSafe(F.col("stored_digest"))
    )
    stored = stored.select(
        *PARTITION,
        F.col("files").alias("stored_files"),
        F.col("bytes").alias("stored_bytes"),
        F.col("digest").alias("stored_digest"),
    )
    return wanted.join(stored, PARTITION, "full").select(
        *PARTITION, "files", "bytes", "stored_files", "stored_bytes", same.alias("ok")
    )


def find_damage(source: DataFrame, path: str, start: int, size: int) -> DataFrame:
    """Heights whose written copy differs from what went in: :func:`digests.damaged_heights`."""
    stored = read_batches(source.sparkSession, path).select(*source.columns, *PARTITION)
    return damaged_heights(height_digests(binned(source, start, size)), height_digests(stored))
