"""Helpers for ordered computations that must not end up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Most rows a relation may have to be broadcast. Rows here are a few numbers or one key.
BROADCAST_ROWS = 200_000

# Hash slices used for ordered numbering: the first four hex digits of an MD5.
SLICES = 65_536

# Ordered height sweeps work in at most this many height slices.
MAX_SLICES = 4096


def broadcast_within(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `df` if it has at most `rows` rows; otherwise leave the join to AQE.

    Counting runs `df` once more, so use it on small derived tables only.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def of_batches(rows: DataFrame, keys: DataFrame, on: Sequence[str] = ("batch_start", "batch_end")) -> DataFrame:
    """Rows of the batches listed in `keys`, a small written table.

    Where `rows` is a batch table, only the folders of these batches are read: those between the
    first and the last of them, whatever their number, and of a listing that can be broadcast its
    very folders. Dynamic partition pruning wants the listing to be a selection, hence the
    comparison, which holds for every batch.
    """
    picked = keys.select(*on).where(F.col("batch_start") >= 0)
    count, low, high = picked.agg(F.count("*"), F.min("batch_start"), F.max("batch_start")).first()
    if not count:
        return rows.where(F.lit(False))
    within = rows.where(F.col("batch_start").between(low, high))
    return within.join(F.broadcast(picked) if count <= BROADCAST_ROWS else picked, list(on), "left_semi")


# Keys a sketch is made of at most, bits per key and bits per word of it: 2 million words, 48 MB.
SKETCH_KEYS, SKETCH_BITS, SKETCH_WORD = 8_000_000, 16, 64


def possibly_among(rows: DataFrame, keys: DataFrame, key: str = "key", name: str = "key") -> DataFrame:
    """`rows` without most of those whose `key` is none of the `keys` (column `name`), before any shuffle.

    All tasks get a sketch of the keys, a bit for each among sixteen: about one in sixteen of the
    other rows stays, so an exact join has to follow. Rows whose key is among the keys all stay.
    With more keys than a sketch is made for, all rows stay.
    """
    count = keys.count()
    if count > SKETCH_KEYS:
        return rows
    bits = 1 << max(6, (SKETCH_BITS * count - 1).bit_length())

    def place(of: str) -> Column:
        return F.pmod(F.xxhash64(F.col(of).cast("string")), F.lit(bits).cast("bigint"))

    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place(name) % SKETCH_WORD).cast("int"))
    word = F.call_function("div", place(name), F.lit(SKETCH_WORD).cast("bigint"))
    words = keys.where(F.col(name).isNotNull()).select(word.alias("_word"), bit.alias("_bit"))
    sketch = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    own = F.call_function("div", place(key), F.lit(SKETCH_WORD).cast("bigint"))
    met = rows.withColumn("_word", own).join(F.broadcast(sketch), "_word")
    return met.where(F.getbit("_bits", (place(key) % SKETCH_WORD).cast("int")) == 1).select(*rows.columns)


def slice_width(start: int, stop: int) -> int:
    """Heights per slice so that ``[start, stop]`` has at most ``MAX_SLICES`` slices."""
    return max(1, -(-(stop - start + 1) // MAX_SLICES))


def hash_slice(key: str | Column) -> Column:
    """Slice number of a key, in the order of the key's MD5."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int")


def running_total(
    df: DataFrame, by: list[str], slice_col: str, order: list[Column], value: Column, name: str, groups: int = 1
) -> DataFrame:
    """Sum of `value` over all earlier rows, in the order of `slice_col`, then `order`.

    The order is cut into slices, ``SLICES`` per `by` group at most. Each slice is summed on
    its own, the totals of earlier slices come from a table with one row per slice, so no
    task sorts more than one slice. `groups` is the number of `by` groups.
    """
    totals = df.groupBy(*by, slice_col).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(slice_col)
    earlier = F.sum("_total").over(before.rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*by, slice_col, F.coalesce(earlier, F.lit(0)).cast("bigint").alias("_offset"))
    # With more groups the rows, already partitioned by slice for the window, meet the
    # offsets in a shuffled join.
    if groups * SLICES <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    within = Window.partitionBy(*by, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)).cast("bigint"))
    total = (F.col("_offset") + F.col("_local")).alias(name)
    return local.join(offsets, [*by, slice_col]).select(*df.columns, total)
