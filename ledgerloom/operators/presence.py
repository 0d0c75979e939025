"""Which heights are there, one bit each.

Heights of a range are cut into buckets of 32,768; a bucket is one bitmap, built within each task
before the shuffle. What is missing comes from bitmaps that are not full; the heights of a range
are never made as rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import whole_div

# Bits and hex digits of a bitmap that Spark's bitmap functions build.
BITS, DIGITS = 32_768, 8_192
# A word of a bitmap: 32 bits in eight digits.
WORD, WORD_DIGITS = 32, 8
# Batches of fewer heights on average than this leave most of a bitmap empty.
SHORT = BITS // 16


def _bucket(offset: Column) -> Column:
    return F.bitmap_bucket_number(offset + 1) - 1


def bitmaps(rows: DataFrame, by: Sequence[str], offset: Column) -> DataFrame:
    """``bucket, bits`` per `by` of the rows' offsets, which count from 0. Repeats are one bit."""
    keyed = rows.select(*by, _bucket(offset).alias("bucket"), F.bitmap_bit_position(offset + 1).alias("_bit"))
    return keyed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of several relations put together."""
    return parts.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _absent(due: DataFrame, found: DataFrame, by: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Heights whose bit is not set in `found`, of the buckets `due`: ``_low, _size, bucket``."""
    held = due.join(found, [*by, "bucket"], "left")
    # Full bitmaps end here. A last one never shows more bits than its range has.
    lacking = held.where(F.coalesce(F.bitmap_count("bits"), F.lit(0)) < F.col("_size"))

    def word(place: Column) -> Column:
        part = F.substring(F.col("_digits"), place * WORD_DIGITS + 1, F.lit(WORD_DIGITS))
        return F.coalesce(part, F.lit("0" * WORD_DIGITS))

    places = F.sequence(F.lit(0), whole_div(F.col("_size") - 1, F.lit(WORD)).cast("int"))
    open_words = F.filter(places, lambda w: word(w) != "F" * WORD_DIGITS)
    words = lacking.withColumn("_digits", F.hex("bits")).withColumn("_word", F.explode(open_words))
    value = F.conv(word(F.col("_word")), 16, 10).cast("bigint")
    bits = words.select(*keep, "_low", "_size", "_word", value.alias("_value")).withColumn(
        "_bit", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1)))
    )
    # The bytes of a word stand in order, each with its lowest bit first.
    unset = F.getbit("_value", F.col("_bit").bitwiseXOR(F.lit(WORD - 8))) == 0
    place = F.col("_word") * WORD + F.col("_bit")
    return bits.where(unset & (place < F.col("_size"))).select(*keep, (F.col("_low") + place).alias("height"))


def _size(first: Column, last: Column) -> Column:
    return F.least(F.lit(BITS).cast("bigint"), last - first + 1)


def absent_heights(spark: SparkSession, present: DataFrame, start: int, stop: int) -> DataFrame:
    """Heights of ``[start, stop]`` that `present` (``height``) does not have."""
    scoped = present.where(F.col("height").between(start, stop))
    found = bitmaps(scoped, (), F.col("height") - start)
    low = F.col("id") * BITS + start
    due = spark.range(max(0, -(-(stop - start + 1) // BITS))).select(
        F.col("id").alias("bucket"), low.alias("_low"), _size(low, F.lit(stop)).alias("_size")
    )
    return _absent(due, found, (), ())


def absent_in_batches(batches: DataFrame, present: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Heights that each batch (``batch_start, batch_end``) lacks in `present`, with its batch.

    `present` holds ``batch_start, batch_end, height``; rows outside their batch count for
    nothing. `keep` names further columns of `batches` that the result carries. The buckets of
    few long batches are dealt out to as many tasks as any shuffle. Of short batches distinct heights
    are shuffled: else each task would make a whole bitmap for the few heights it has of a batch.
    """
    by = ["batch_start", "batch_end"]
    inside = present.where(F.col("height").between(F.col("batch_start"), F.col("batch_end")))
    length = batches.agg(F.avg(F.col("batch_end") - F.col("batch_start") + 1)).first()[0]
    if length is not None and length < SHORT:
        inside = inside.select(*by, "height").distinct().repartition(*by)
    found = bitmaps(inside, by, F.col("height") - F.col("batch_start"))
    columns = [c for c in batches.columns if c in by or c in keep]
    count = whole_div(F.col("batch_end") - F.col("batch_start"), F.lit(BITS))
    numbered = batches.where("batch_end >= batch_start").select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), count)).alias("bucket")
    )
    low = F.col("batch_start") + F.col("bucket") * BITS
    due = numbered.select("*", low.alias("_low"), _size(low, F.col("batch_end")).alias("_size"))
    partitions = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _absent(due.repartition(partitions, *by, "bucket"), found, by, columns)
