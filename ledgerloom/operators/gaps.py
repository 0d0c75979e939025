"""Missing heights and shards, source choice, repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.checks import is_present, valid_payload, whole_div
from ..functions.keys import shard_member
from ..session import materialise
from .common import broadcast_within, slice_width
from .presence import absent_heights, absent_in_batches
from .ranges import assign_batch

BLOCK = "block.json"
HEIGHT = ("height",)
# Archives may begin at one height and end at different ones.
BATCH = ("batch_start", "batch_end")


def present_heights(objects: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """Heights with a non-empty block, without repeats."""
    blocks = objects.where((F.col("member") == BLOCK) & is_present("size"))
    return blocks.select(*by).distinct()


def missing_heights(domain: DataFrame, objects: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """Heights of `domain` without a non-empty block in `objects` (``height, member, size``).

    `by` names the columns that identify a height, for example with its archive.
    """
    return domain.join(present_heights(objects, by), list(by), "left_anti")


def _blocks(objects: DataFrame) -> DataFrame:
    return objects.where((F.col("member") == BLOCK) & is_present("size"))


def missing_in_range(objects: DataFrame, start: int, stop: int) -> DataFrame:
    """Heights of ``[start, stop]`` without a non-empty block in `objects`.

    The same as :func:`missing_heights` of the whole range, by bitmaps: no height that is there
    becomes a row of its own.
    """
    return absent_heights(objects.sparkSession, _blocks(objects).select("height"), start, stop)


def missing_in_batches(batches: DataFrame, objects: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Heights without a non-empty block per batch, both with ``batch_start, batch_end``, by bitmaps.

    `keep` names further columns of `batches` that the result carries.
    """
    return absent_in_batches(batches, _blocks(objects).select(*BATCH, "height"), keep)


def missing_shards(expected: DataFrame, objects: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """Expected shards without a non-empty file, for heights whose block is present.

    `expected` holds ``height, shard_id``, `objects` holds ``height, member, size``.
    """
    files = objects.where((F.col("member") != BLOCK) & is_present("size"))
    found = files.select(*by, "member").distinct()
    # Only what no file has, a small rest, meets the present blocks.
    wanted = expected.withColumn("member", shard_member("shard_id"))
    absent = wanted.join(found, [*by, "member"], "left_anti").drop("member")
    return absent.join(present_heights(objects, by), list(by), "left_semi")


def first_source(objects: DataFrame, check_overlap: bool = False) -> DataFrame:
    """All members of each height from the first source that lists any object of it.

    Sources are never mixed within a height, and empty files count as listed.

    By default the wide rows meet one small row per height in an equi-join, where AQE splits
    a height that holds too much. With `check_overlap`, listings that lose are counted first;
    if they are few enough to broadcast, the wide rows are not shuffled at all.
    """
    if not check_overlap:
        winner = objects.groupBy("height").agg(F.min("priority").alias("priority"))
        return objects.join(winner, ["height", "priority"], "left_semi")
    listed = objects.select("height", "priority").distinct()
    best = listed.groupBy("height").agg(F.min("priority").alias("_best"))
    losing = listed.join(best, "height").where("priority > _best").select("height", "priority")
    losing = broadcast_within(materialise(losing, "losing"))
    return objects.join(losing, ["height", "priority"], "left_anti")


def refetch_set(missing_h: DataFrame, missing_s: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """Heights to fetch again: absent ones and those with an absent shard."""
    return missing_h.select(*by).union(missing_s.select(*by)).distinct()


def fit_fallback(fallback: DataFrame, need_block: bool = True) -> DataFrame:
    """Rows of the heights whose fetched block can be used: some bytes and, where there is a
    ``payload``, a JSON object with content.

    With `need_block` heights without any block are left out, too.
    """
    fit = is_present("size")
    if "payload" in fallback.columns:
        fit = fit & F.coalesce(valid_payload(F.col("payload").cast("string")), F.lit(False))
    blocks = fallback.where(F.col("member") == BLOCK)
    good = blocks.where(fit).select("height").distinct()
    rows = fallback.where((F.col("member") != BLOCK) | fit)
    if need_block:
        return rows.join(good, "height", "left_semi")
    unfit = blocks.select("height").distinct().join(good, "height", "left_anti")
    return rows.join(unfit, "height", "left_anti")


def fill_gaps(primary: DataFrame, fallback: DataFrame, wanted: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """`primary` with the members of the `wanted` heights taken from `fallback`.

    A fetched member replaces the one of the same name; other members of the height stay.
    Both inputs hold ``height, member`` and the same further columns; columns that `wanted` has
    beside the height, for example its archive, are added to the fetched rows.
    """
    fetched = fallback.join(wanted, "height")
    kept = primary.join(fetched.select(*by, "member"), [*by, "member"], "left_anti")
    return kept.unionByName(fetched.select(*primary.columns))


def still_missing(
    primary: DataFrame, fallback: DataFrame, wanted: DataFrame, expected: DataFrame, by: Sequence[str] = HEIGHT
) -> tuple[DataFrame, DataFrame]:
    """Heights and shards that are missing after :func:`fill_gaps`, out of the `wanted` heights alone.

    Filling touches no other height, so nothing else is scanned again. `wanted` is all that was
    missing before, `expected` the shards of all heights; both are small or written.
    """
    named = wanted.select(*by)
    touched = primary.join(named, list(by), "left_semi").select(*by, "member", "size")
    after = fill_gaps(touched, fallback.select("height", "member", "size"), named, by)
    return missing_heights(named, after, by), missing_shards(expected.join(named, list(by), "left_semi"), after, by)


def fallback_missing(wanted: DataFrame, fallback: DataFrame, by: Sequence[str] = HEIGHT) -> DataFrame:
    """Wanted heights the fallback does not have."""
    return wanted.select(*by).join(fallback.select("height").distinct(), "height", "left_anti").select(*by)


def _batched(df: DataFrame, start: int, size: int) -> DataFrame:
    """Adds the batch by arithmetic unless the rows already say which one they belong to."""
    return df if set(BATCH) <= set(df.columns) else assign_batch(df, start, size)


def batch_gaps(missing_h: DataFrame, missing_s: DataFrame, start: int = 0, size: int = 1) -> DataFrame:
    """Missing heights and shards per batch, one row per batch with any."""
    h = _batched(missing_h, start, size).select(*BATCH, F.lit(None).cast("string").alias("shard_id"))
    s = _batched(missing_s, start, size).select(*BATCH, F.col("shard_id").cast("string").alias("shard_id"))
    return h.unionByName(s).groupBy(*BATCH).agg(
        F.count_if(F.col("shard_id").isNull()).alias("n_heights"), F.count("shard_id").alias("n_shards")
    )


def complete_batches(
    batches: DataFrame, missing_h: DataFrame, missing_s: DataFrame, start: int = 0, size: int = 1
) -> DataFrame:
    """Batches with nothing missing after a re-scan; only these may replace stored ones."""
    gaps = batch_gaps(missing_h, missing_s, start, size)
    by = [c for c in BATCH if c in batches.columns]
    return batches.join(gaps.select(*by), by, "left_anti")


def problem_report(
    missing_h: DataFrame, missing_s: DataFrame, start: int = 0, size: int = 1, by: Sequence[str] = HEIGHT
) -> DataFrame:
    """Everything that is missing, one row per height, with its batch.

    ``missing_shard_ids`` is null for an absent height; otherwise it holds the absent ids of
    one block, sorted.
    """
    ids = missing_s.groupBy(*by).agg(
        F.sort_array(F.collect_set(F.col("shard_id").cast("string"))).alias("missing_shard_ids")
    )
    absent = missing_h.select(*by, F.lit(None).cast("array<string>").alias("missing_shard_ids"))
    return _batched(absent.unionByName(ids), start, size)


def layout_check(objects: DataFrame, start: int = 0, size: int = 1) -> DataFrame:
    """Whether the present heights of a batch share one parent folder.

    `objects` holds ``parent, height, member, size``. ``verdict`` is ``ok`` or
    ``inconsistent``; ``parent`` is the shared folder, null when there are several.
    """
    present = objects.where((F.col("member") == BLOCK) & is_present("size"))
    folders = _batched(present, start, size).select(*BATCH, "parent").distinct()
    one = F.col("folders") == 1
    return (
        folders.groupBy(*BATCH)
        .agg(F.count("*").alias("folders"), F.min("parent").alias("_parent"))
        .select(
            *BATCH,
            "folders",
            F.when(one, F.col("_parent")).alias("parent"),
            F.when(one, "ok").otherwise("inconsistent").alias("verdict"),
        )
    )


def fill_totals(events: DataFrame) -> DataFrame:
    """Gaps found, filled and failed per batch."""
    return events.groupBy(*BATCH).agg(
        F.count_if(F.col("kind") == "gap_found").alias("found"),
        F.count_if(F.col("kind") == "gap_filled").alias("filled"),
        F.count_if(F.col("kind").isin("gap_fill_failed", "fallback_not_found")).alias("failed"),
    )


def empty_runs(missing: DataFrame, start: int, stop: int) -> DataFrame:
    """Runs of consecutive missing heights in ``[start, stop]``: ``run_start, run_end, n``.

    Runs are built inside height slices; only the ones that touch a slice edge, two per
    slice at most, are joined up in order afterwards.
    """
    width = slice_width(start, stop)
    scoped = missing.select("height").where(F.col("height").between(start, stop)).distinct()
    sliced = scoped.withColumn("_slice", whole_div(F.col("height") - start, F.lit(width)))
    order = Window.partitionBy("_slice").orderBy("height")
    runs = (
        sliced.withColumn("_island", F.col("height") - F.row_number().over(order))
        .groupBy("_slice", "_island")
        .agg(F.min("height").alias("run_start"), F.max("height").alias("run_end"))
    )
    slice_first = F.lit(start) + F.col("_slice") * width
    touches = (F.col("run_start") == slice_first) | (F.col("run_end") == slice_first + (width - 1))
    runs = runs.select("run_start", "run_end", touches.alias("_edge"))
    inner = runs.where(~F.col("_edge")).select("run_start", "run_end")
    in_order = Window.partitionBy(F.lit(0)).orderBy("run_start")
    opens = F.coalesce(F.col("run_start") != F.lag("run_end").over(in_order) + 1, F.lit(True))
    edges = (
        runs.where("_edge")
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_run", F.sum("_opens").over(in_order))
        .groupBy("_run")
        .agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))
        .select("run_start", "run_end")
    )
    return inner.unionByName(edges).withColumn("n", F.col("run_end") - F.col("run_start") + 1)


def stop_height(runs: DataFrame, limit: int) -> DataFrame:
    """First height at which `limit` heights in a row were missing, one row ``height``."""
    return runs.where(F.col("n") >= limit).agg(F.min(F.col("run_start") + (limit - 1)).alias("height"))


def heights_until(domain: DataFrame, stop: DataFrame) -> DataFrame:
    """Heights up to the stop height, all of them when there is none. `stop` has one row."""
    limit = stop.agg(F.max("height")).scalar()
    return domain.where(F.col("height") <= F.coalesce(limit, F.lit(2**63 - 1)))
