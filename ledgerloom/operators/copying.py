"""Copies between inventories: plan, schedule, reconciliation, delete plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import is_present, whole_div
from ..functions.keys import ARCHIVE_KEY, dest_key, etag_md5
from .common import hash_slice, possibly_among, running_total

DELETE_PAGE = 1000


def to_fetch(source: DataFrame, local: DataFrame) -> DataFrame:
    """Objects without a non-empty local copy, matched on ``height, member``."""
    held = local.where(is_present("size")).select("height", "member")
    return source.join(held, ["height", "member"], "left_anti")


def _candidates(source: DataFrame, source_prefix: str, dest_prefix: str, all_keys: bool) -> DataFrame:
    base = source_prefix.strip()
    listed = source.where(F.col("key").startswith(base if base.endswith("/") else f"{base}/"))
    named = F.lit(True) if all_keys else F.col("key").rlike(ARCHIVE_KEY)
    return listed.select(
        "*", named.alias("named"), dest_key("key", source_prefix, dest_prefix).alias("dest_key")
    )


def copy_plan(
    source: DataFrame,
    dest: DataFrame,
    source_prefix: str,
    dest_prefix: str = "",
    overwrite: bool = False,
    copy_all_under_prefix: bool = False,
) -> DataFrame:
    """Keys to copy with their destination key.

    Only range archives are copied unless `copy_all_under_prefix`; keys that exist at the
    destination are left out unless `overwrite`.
    """
    plan = _candidates(source, source_prefix, dest_prefix, copy_all_under_prefix).where("named").drop("named")
    if overwrite:
        return plan
    # Of a destination much larger than the plan, only what may match is shuffled.
    held = possibly_among(dest.select(F.col("key").alias("dest_key")), plan, "dest_key", "dest_key")
    return plan.join(held, "dest_key", "left_anti")


def copy_counters(
    source: DataFrame,
    dest: DataFrame,
    source_prefix: str,
    dest_prefix: str = "",
    overwrite: bool = False,
    copy_all_under_prefix: bool = False,
) -> DataFrame:
    """One row: keys listed, skipped by name, skipped as existing, and copied."""
    marked = _candidates(source, source_prefix, dest_prefix, copy_all_under_prefix)
    held = dest.select(F.col("key").alias("dest_key"), F.lit(True).alias("_held")).distinct()
    marked = marked.join(held, "dest_key", "left")
    exists = F.col("_held").isNotNull() & F.lit(not overwrite)
    return marked.agg(
        F.count("*").alias("listed"),
        F.count_if(~F.col("named")).alias("skipped_filter"),
        F.count_if(F.col("named") & exists).alias("skipped_existing"),
        F.count_if(F.col("named") & ~exists).alias("copied"),
    )


def reconcile(source: DataFrame, dest: DataFrame, include_extra: bool = False) -> DataFrame:
    """Verdict per copied key: ``missing``, ``size_mismatch``, ``md5_mismatch`` or ``ok``.

    `source` holds ``dest_key, size, etag``, `dest` holds ``key, size, etag``. MD5 counts only
    where both ETags are single-part ones. Of repeated destination keys the largest counts. With `include_extra`, destination keys without a
    source are reported as ``extra``.
    """
    left = source.select(F.col("dest_key").alias("key"), "size", etag_md5("etag").alias("md5"), F.lit(True).alias("_s"))
    held = dest.groupBy("key").agg(F.max(F.struct("size", "etag")).alias("_o"))
    right = held.select(
        "key", F.col("_o.size").alias("dest_size"), etag_md5("_o.etag").alias("dest_md5"), F.lit(True).alias("_d")
    )
    verdict = (
        F.when(F.col("_s").isNull(), "extra")
        .when(F.col("_d").isNull(), "missing")
        .when(F.col("size") != F.col("dest_size"), "size_mismatch")
        .when(F.col("md5") != F.col("dest_md5"), "md5_mismatch")
        .otherwise("ok")
    )
    both = left.join(right, "key", "full" if include_extra else "left")
    return both.select("key", verdict.alias("verdict"))


def verify_content(objects: DataFrame) -> DataFrame:
    """Verdict per read object against its own ETag and size (``key, size, etag, content``)."""
    verdict = (
        F.when(F.octet_length("content") != F.col("size"), "size_mismatch")
        .when(F.md5("content") != etag_md5("etag"), "md5_mismatch")
        .otherwise("ok")
    )
    return objects.select("key", verdict.alias("verdict"))


def exists_keys(keys: DataFrame, inventory: DataFrame) -> DataFrame:
    """``FOUND`` or ``MISSING`` per key."""
    held = possibly_among(inventory.select("key"), keys).distinct().withColumn("_held", F.lit(True))
    status = F.when(F.col("_held"), "FOUND").otherwise("MISSING")
    return keys.select("key").join(held, "key", "left").select("key", status.alias("status"))


def delete_manifest(inventory: DataFrame, prefix: str = "", page_size: int = DELETE_PAGE) -> DataFrame:
    """Keys under `prefix` in pages of `page_size`, a plan only.

    Every page but the last is full. Pages follow the MD5 of the keys, so numbering spreads
    evenly over hash slices whatever the keys look like.
    """
    return sized_manifest(inventory.select("key", F.lit(0).alias("size")), prefix, page_size).select("key", "page")


def sized_manifest(inventory: DataFrame, prefix: str = "", page_size: int = DELETE_PAGE) -> DataFrame:
    """:func:`delete_manifest` with the size of each key, the largest of repeated ones."""
    keys = inventory.where(F.col("key").startswith(prefix)).groupBy("key").agg(F.max("size").alias("size"))
    sliced = keys.withColumn("_slice", hash_slice("key"))
    numbered = running_total(sliced, [], "_slice", [F.md5("key"), F.col("key")], F.lit(1), "_before")
    return numbered.select("key", "size", whole_div("_before", F.lit(page_size)).alias("page"))


def copy_schedule(plan: DataFrame, lanes: int, bps: int) -> DataFrame:
    """Lane and start second of every copy under a total cap of `bps` bytes per second.

    Each lane gets an equal share of the cap and copies its keys one after the other, in the
    order of their MD5. A cap of 0 starts everything at second 0.
    """
    lane = F.pmod(F.conv(F.substring(F.md5("key"), 25, 8), 16, 10).cast("bigint"), F.lit(lanes))
    laned = plan.select("key", "size", lane.cast("bigint").alias("lane"), hash_slice("key").alias("_slice"))
    order = [F.md5("key"), F.col("key")]
    queued = running_total(laned, ["lane"], "_slice", order, F.col("size"), "_before", groups=lanes)
    slot = whole_div(F.col("_before") * lanes, F.lit(bps)) if bps > 0 else F.lit(0)
    return queued.select("key", "lane", slot.cast("bigint").alias("slot"))
