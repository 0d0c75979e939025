"""Whole jobs: archive, stage, fill gaps, audit and repair, validate, copy, check, purge plan.

Each job returns its summary as a DataFrame. Small results that several steps need (missing
heights, batches to repair) are written to the shared folder once. Payload columns only move
where bytes are really rewritten.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import safe_boundary
from ..functions.keys import PAD_WIDTH, below, parse_archives, path_parts, range_name
from ..operators import copying, gaps, ranges, stats
from ..operators.common import broadcast_within, of_batches
from ..operators.presence import absent_in_batches
from ..session import discard, materialise, scratch_path
from ..sinks import archives as tar_sink
from ..sinks import batches as sink
from ..sinks import records, transfer
from ..sinks.versions import VersionedTable
from ..sources import inventory, payloads, tar

BATCH = gaps.BATCH
BY = (*BATCH, "height")


def _one(df: DataFrame):
    """The only value of a one-row result."""
    return df.first()[0]


def pending_work(
    spark: SparkSession,
    stored: DataFrame,
    start_from: int,
    stop_at: int,
    size: int,
    control: DataFrame | None = None,
    prefix: str = "archives",
    codec: str = "zstd",
) -> DataFrame:
    """Whole batches up to `stop_at` that are neither sealed nor stored under their key."""
    due = inventory.expected_batches(spark, start_from, stop_at, size)
    due = due.where(F.col("batch_end") == F.col("batch_start") + size - 1)
    if control is not None:
        due = due.where(F.col("batch_start") >= _one(inventory.resume_point(control, start_from)))
    return ranges.pending_batches(due, stored, prefix, codec)


def archive_job(
    objects: DataFrame,
    stored: DataFrame,
    out: str,
    *,
    start_from: int,
    size: int,
    stop_at: int | None = None,
    latest: DataFrame | None = None,
    hot: int = 0,
    fallback: DataFrame | None = None,
    consecutive_empty: int | None = None,
    control: DataFrame | None = None,
    control_path: str | None = None,
    stats_path: str | None = None,
    prefix: str = "archives",
    codec: str = "zstd",
    level: int | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Compact pending batches out of ordered sources, filling absent heights from a fallback.

    `objects` is a union of sources, `stored` the inventory of archives that exist. Batches
    end at `stop_at`, or at the safe boundary behind `latest`. Returns one row per batch with
    ``dirs, files, bytes, empty_heights, status``; status is ``archived``, ``empty`` or, in a
    dry run, ``pending``.
    """
    spark = objects.sparkSession
    if stop_at is None:
        stop_at = _one(latest.select(safe_boundary("latest", size, hot))) or 0
        if stop_at <= 0:  # nothing is safe yet
            stop_at = start_from - 1
    pending = materialise(
        pending_work(spark, stored, start_from, stop_at, size, control, prefix, codec), "pending"
    )
    # The outer bounds reach the scan as a range filter, the exact batches as a join.
    low, high = inventory.height_bounds(pending.select(F.explode(F.array("batch_start", "batch_end")).alias("height")))
    binned = ranges.assign_batch(objects.where(F.col("height").between(low, high)), start_from, size)
    listed = of_batches(binned, pending, ["batch_start"])
    if fallback is not None:
        # A fetched height without a block is taken for shards alone; an unusable block is no height.
        fallback = gaps.fit_fallback(fallback, need_block=False)
    unlisted = materialise(absent_in_batches(pending, listed.select(*BY)), "unlisted")
    empty = gaps.fallback_missing(unlisted, fallback, BY) if fallback is not None else unlisted
    if consecutive_empty:
        runs = gaps.empty_runs(empty, start_from, stop_at)
        end = _one(gaps.stop_height(runs, consecutive_empty))
        if end is not None:
            pending, listed, unlisted, empty = (
                df.where(F.col("batch_start") <= end) for df in (pending, listed, unlisted, empty)
            )
    counts = empty.groupBy("batch_start").agg(F.count("*").alias("empty_heights"))
    if dry_run:
        plan = stats.batch_stats(gaps.first_source(listed), start_from, size)
        return _batch_summary(pending, plan, counts, F.lit("pending"))

    rows = gaps.first_source(listed, check_overlap=True)
    if fallback is not None:
        # Unlisted heights have no rows of their own, so nothing needs replacing.
        fetched = fallback.join(unlisted.select("height"), "height", "left_semi")
        rows = rows.unionByName(ranges.assign_batch(fetched, start_from, size).select(*rows.columns))
    began = time.monotonic()
    totals = sink.replace_batches(rows, out, codec=codec, level=level, batches=pending)
    run_sec = time.monotonic() - began
    # The bounds leave out the folders of earlier runs.
    back = sink.read_batches(spark, out, rows.schema).where(F.col("batch_start").between(low, high))
    stored_rows = of_batches(back, pending, ["batch_start"])
    sink.require_totals(stored_rows, totals, out)
    done = materialise(stats.batch_stats(stored_rows, start_from, size), "stats")
    if stats_path and totals["files"]:  # empty batches have no statistics line
        listing = sink.batch_inventory(spark, out, between=(low, high))
        sizes = listing.select("batch_start", F.col("size").alias("stored_bytes"))
        packed = done.join(sizes, "batch_start", "left")
        records.append_stats(records.batch_stats_rows(packed, "stored_bytes", run_sec), stats_path)
    if control_path:
        records.save_progress(pending, control_path)
    status = F.when(F.col("files") > 0, "archived").otherwise("empty")
    return _batch_summary(pending, done, counts, status)


def _batch_summary(batches: DataFrame, sizes: DataFrame, empty: DataFrame, status) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return (
        batches.select("batch_start", "batch_end")
        .join(sizes.drop("batch_end"), "batch_start", "left")
        .join(empty, "batch_start", "left")
        .select(
            "batch_start",
            "batch_end",
            *(F.coalesce(F.col(c), zero).alias(c) for c in ("dirs", "files", "bytes", "empty_heights")),
        )
        .withColumn("status", status)
    )


def stage_job(
    objects: DataFrame,
    local: DataFrame,
    out: str,
    *,
    start_from: int,
    stop_at: int,
    size: int,
    stats_path: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Bring the objects of ``[start_from, stop_at]`` to a staging table, skipping non-empty copies.

    Returns files and bytes fetched and skipped per batch.
    """
    scoped = objects.where(F.col("height").between(start_from, stop_at))
    chosen = gaps.first_source(scoped, check_overlap=True)
    per_height = stats.fetch_stats(chosen, local)
    sums = ("files_fetched", "files_skipped", "bytes_fetched", "bytes_skipped")
    per_batch = (
        ranges.assign_batch(per_height, start_from, size)
        .groupBy("batch_start", "batch_end")
        .agg(F.count("*").alias("dirs"), *(F.sum(c).alias(c) for c in sums))
    )
    if dry_run:
        return per_batch
    # `local` may be the staging table itself: take its state before anything is appended.
    done = materialise(per_batch, "staged")
    began = time.monotonic()
    sink.merge_heights(copying.to_fetch(chosen, local), out, start_from, size)
    if stats_path:
        lines = done.withColumn("bytes", F.col("bytes_fetched") + F.col("bytes_skipped"))
        run_sec = time.monotonic() - began
        records.append_stats(records.download_stats_rows(lines, out, run_sec), stats_path)
    return done


def fix_gaps_job(
    folders: DataFrame,
    objects: DataFrame,
    fallback: DataFrame | None,
    out: str | None = None,
    *,
    replies: DataFrame | None = None,
    base_url: str | None = None,
    api_key: str = "",
    events_path: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Fill absent heights of staged batch folders from the fallback.

    The fallback is a table of members, or `replies` as they were fetched (``height, body``, see
    :func:`payloads.split_envelope`). A reply with an unusable block or shard fills nothing; its
    event says why.

    `folders` holds the folder ``name``, `objects` holds ``batch_start, batch_end, parent,
    height, member, size``. Filled members go to `out` in place of those of the same name.
    Returns found, filled and failed per batch; heights whose fetched block is absent or unusable
    are failed ones, batches with several parent folders are reported and left alone.
    """
    found = inventory.parse_batch_paths(folders).select(
        F.col("first").alias("batch_start"), F.col("last").alias("batch_end")
    )
    layout = materialise(gaps.layout_check(objects), "layout")
    mixed = layout.where("verdict = 'inconsistent'").select(*BATCH)
    sound = found.join(mixed, list(BATCH), "left_anti")
    lost = gaps.missing_in_batches(sound, objects)
    lost = materialise(lost.join(layout.select(*BATCH, "parent"), list(BATCH), "left"), "lost")
    broken = None
    if replies is not None:
        fallback, broken = _from_replies(replies, lost)
    fit = gaps.fit_fallback(fallback)
    if broken is None:
        known, unfit = fallback, _unfit(lost, fallback, fit).withColumn("error", F.lit(UNFIT))
    else:
        fit = fit.join(broken, "height", "left_anti")
        known, unfit = replies, lost.join(broken, "height")
    absent = gaps.fallback_missing(lost, known, (*BY, "parent"))
    got = lost.join(fit.select("height").distinct(), "height", "left_semi")
    parts = [
        records.gap_events(lost, "gap_found", dry_run=F.lit(True if dry_run else None)),
        records.event(
            found.join(mixed, list(BATCH), "left_semi"), "archive_problem", error=F.lit("inconsistent path layout")
        ),
    ]
    if not dry_run:
        parts += [
            records.gap_events(got, "gap_filled", base_url, api_key),
            records.gap_events(absent, "fallback_not_found", base_url, api_key),
            records.event(unfit, "gap_fill_failed"),
        ]
        if out:
            fetched = fit.join(lost.fillna("", ["parent"]), "height")
            sink.merge_heights(fetched, out)
    events = records.audit_events(parts)
    if events_path:
        records.append_lines(events, events_path)
    return gaps.fill_totals(events)


UNFIT = "fetched block is absent, empty or no JSON object"


def _from_replies(replies: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members held by the replies of the wanted heights, and ``height, error`` of the broken ones."""
    asked = replies.join(wanted.select("height").distinct(), "height", "left_semi")
    problems = payloads.envelope_problems(asked).groupBy("height").agg(F.min("error").alias("error"))
    return payloads.split_envelope(asked), materialise(problems, "broken-replies")


def _unfit(wanted: DataFrame, fallback: DataFrame, fit: DataFrame) -> DataFrame:
    """Wanted heights that the fallback knows, but has no usable block of."""
    known = wanted.join(fallback.select("height").distinct(), "height", "left_semi")
    return known.join(fit.select("height").distinct(), "height", "left_anti")


def import_job(
    spark: SparkSession, folder: str, out: str, prefix: str | None = "archives", width: int = PAD_WIDTH
) -> DataFrame:
    """Bring existing tar archives below `folder` into a batch table for the audit.

    Archives count if they lie in the subfolder `prefix`; of several with one range the first
    key is taken. With a `prefix` of None, archives anywhere count, and those of one range are
    parts of it, as :func:`pack_archives` writes them. Height folders have names of `width` digits.
    Members become rows of `out` with ``batch_start, batch_end, parent, height, member, size,
    payload``; members outside height folders stay with their archive, under their whole path and
    without a height. Returns the archives that could not be read, as ``batch_start, error``.
    """
    listed = tar.archive_paths(spark, folder).withColumn("key", below("path", folder))
    found = parse_archives(listed, prefix or "", exact_prefix=prefix is not None)
    if prefix is not None:
        found = found.groupBy("first", "last").agg(F.min_by("path", "key").alias("path"))
    found = found.select(
        F.col("path").alias("archive"), F.col("first").alias("batch_start"), F.col("last").alias("batch_end")
    )
    scratch: list[str] = []
    found = materialise(found, "found", scratch)
    members = materialise(tar.expand_archives(found.select(F.col("archive").alias("path"))), "members", scratch)
    ranged = tar.readable_members(members).join(broadcast_within(found), "archive")
    rows = ranged.withColumn("_p", path_parts("member", width)).select(
        "batch_start",
        "batch_end",
        F.when(F.col("_p.height").isNotNull(), F.col("_p.parent")).alias("parent"),
        F.col("_p.height").alias("height"),
        F.when(F.col("_p.height").isNotNull(), F.col("_p.member")).otherwise(F.col("member")).alias("member"),
        "size",
        F.col("payload").cast("string").alias("payload"),
    )
    totals = sink.replace_batches(rows, out)
    sink.require_totals(of_batches(sink.read_batches(spark, out, rows.schema), found), totals, out)
    failed = members.where("error is not null").join(found, "archive")
    failed = materialise(failed.select("batch_start", "batch_end", "error"), "failed")
    for part in scratch:  # the table holds all of it
        discard(spark, part)
    return failed


def pack_job(
    objects: DataFrame,
    folder: str,
    *,
    start_from: int,
    size: int,
    codec: str = "zstd",
    level: int = 6,
    stats_path: str | None = None,
) -> DataFrame:
    """Write objects (``height, member, payload``) as tar archives by range, and what that took.

    Returns one row per range: folders, members, bytes, stored bytes and the seconds its tasks
    waited for rows, compressed and wrote; a range cut into several archives is one row. With
    `stats_path` each range is a statistics line, too.
    """
    manifest = tar_sink.pack_archives(objects, folder, start_from, size, codec, level)
    sums = ("members", "dirs", "bytes", "stored", "download_sec", "compress_sec", "upload_sec")
    done = materialise(manifest.groupBy(*BATCH).agg(*(F.sum(c).alias(c) for c in sums)), "packed")
    if stats_path:
        records.append_stats(records.batch_stats_rows(done, "stored"), stats_path)
    return done


def audit_repair_job(
    stored: DataFrame,
    objects: DataFrame,
    fallback: DataFrame,
    path: str | VersionedTable | None = None,
    *,
    start_from: int = 0,
    stop_at: int | None = None,
    prefix: str = "archives",
    unreadable: DataFrame | None = None,
    base_url: str | None = None,
    events_path: str | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Find archives with missing heights or shards, refill them, replace the complete ones.

    `stored` is the archive inventory, `objects` the members of all archives with
    ``batch_start, batch_end, parent, height, member, size, payload`` (a written table),
    `path` the batch table whose partitions may be replaced, `unreadable` archives that could
    not be expanded (``batch_start, error``). In a :class:`VersionedTable` all repaired archives
    change by one commit, which leaves out those that do not read back as written; in a plain
    table a read-back that fails fails them all. Returns one row per archive with what was missing
    and ``status``: ``ok``, ``problem``, ``repaired``, ``incomplete``, ``failed``, ``unreadable``.
    """
    spark = stored.sparkSession
    archives = ranges.scope_filter(ranges.first_archive(parse_archives(stored, prefix)), start_from, stop_at)
    archives = materialise(
        archives.select(
            F.col("key").alias("archive_key"), F.col("first").alias("batch_start"), F.col("last").alias("batch_end")
        ),
        "archives",
    )
    # Rows outside the range of their archive are not judged, but stay with it when it is rewritten.
    inside = F.col("height").between(F.col("batch_start"), F.col("batch_end"))
    whole = of_batches(objects, archives)
    members = whole.where(inside)
    heads = members.where((F.col("member") == gaps.BLOCK) & (F.col("size") > 0))
    checked = materialise(payloads.read_headers(heads.select(*BY, "payload"), BY), "headers")

    # What makes an archive unusable as a whole.
    layout = materialise(gaps.layout_check(members), "layout")
    errors = [
        layout.where("verdict = 'inconsistent'").select(
            *BATCH, F.lit("scan layout: several parent folders").alias("error")
        ),
        checked.where("error is not null").select(*BATCH, F.concat(F.lit("shard scan: "), "error").alias("error")),
    ]
    if unreadable is not None:
        if "batch_end" not in unreadable.columns:  # all archives that begin there
            unreadable = unreadable.join(archives.select(*BATCH), "batch_start")
        errors.append(unreadable.select(*BATCH, "error"))
    bad = errors[0]
    for more in errors[1:]:
        bad = bad.unionByName(more)
    bad = materialise(bad.groupBy(*BATCH).agg(F.min("error").alias("error")), "unusable")
    sound = archives.join(bad, list(BATCH), "left_anti")

    slim = members.select(*BY, "member", "size")
    expected = payloads.shards_of(checked, BY).join(sound, ["batch_start", "batch_end"], "left_semi")
    lost_h = materialise(gaps.missing_in_batches(sound, slim), "missing-heights")
    lost_s = materialise(gaps.missing_shards(expected, slim, BY), "missing-shards")
    report = gaps.problem_report(lost_h, lost_s, by=BY)
    named = archives.select("archive_key", *BATCH)
    dry = F.lit(True if dry_run else None)
    events = [
        records.event(report.join(named, list(BATCH)), "archive_problem", dry_run=dry),
        records.event(archives.join(bad, list(BATCH)), "archive_problem", dry_run=dry),
        records.event(archives.join(bad, list(BATCH)), "archive_repair_failed"),
    ]
    done = still = None
    if not dry_run:
        wanted = materialise(gaps.refetch_set(lost_h, lost_s, BY), "wanted")
        # Read once; what follows looks at the wanted heights alone, several times.
        fetched: list[str] = []
        fallback = materialise(
            fallback.join(wanted.select("height").distinct(), "height", "left_semi"), "fetched", fetched
        )
        fit = gaps.fit_fallback(fallback)
        absent = gaps.fallback_missing(wanted, fallback, BY)
        unfit = _unfit(wanted, fallback, fit)
        touched = materialise(wanted.select("batch_start", "batch_end").distinct(), "touched")
        # Only partitions of broken batches are read with their payload.
        broken = of_batches(whole, touched)
        table = path if isinstance(path, VersionedTable) else None
        staging = None if table else scratch_path(spark, "repaired")
        # Fetched members go to the folder the batch uses.
        placed = wanted.join(layout.select(*BATCH, "parent"), list(BATCH), "left").fillna("", ["parent"])
        filled = gaps.fill_gaps(broken, fit, placed, BY)
        if table:
            # Written once, in its place, and seen by nobody until it is committed.
            staged = table.stage(filled, batches=touched)
            fixed = table.staged(staged)
        else:
            sink.write_batches(filled, staging)
            fixed = sink.read_batches(spark, staging, filled.schema)
        heads = fixed.where(inside & (F.col("member") == gaps.BLOCK) & (F.col("size") > 0))
        again = payloads.read_headers(heads.select(*BY, "payload"), BY)
        slim = fixed.where(inside).select(*BY, "member", "size")
        still_h = gaps.missing_in_batches(touched, slim)
        still_s = gaps.missing_shards(payloads.shards_of(again, BY), slim, BY)
        # A fetched block that cannot be read keeps its batch incomplete, too.
        broken_h = again.where("error is not null").select(*BY)
        still = materialise(gaps.problem_report(still_h.select(*BY).union(broken_h), still_s, by=BY), "still-missing")
        done = materialise(
            touched.join(still.select(*BATCH).distinct(), list(BATCH), "left_anti"), "complete"
        )
        damaged = done.limit(0)
        if table:
            bad_batches = table.damaged(staged, filled)
            if bad_batches is not None:
                damaged = materialise(done.join(bad_batches, list(BATCH), "left_semi"), "damaged")
                done = materialise(done.join(damaged, list(BATCH), "left_anti"), "intact")
            if not done.isEmpty():
                table.commit(staged, done)
            table.forget(staged)
        elif path:
            ready = of_batches(fixed, done)
            totals = sink.replace_batches(ready, path)
            if not sink.verify_totals(of_batches(sink.read_batches(spark, path, ready.schema), done), totals):
                damaged, done = done, done.limit(0)
        if staging:
            discard(spark, staging)
        reason = F.lit("gaps remain after refetch; archive not replaced")
        events += [
            records.gap_events(absent.join(named, list(BATCH)), "fallback_not_found", base_url),
            records.event(unfit.join(named, list(BATCH)), "gap_fill_failed", error=F.lit(UNFIT)),
            records.event(still.join(named, list(BATCH)), "archive_repair_skipped_incomplete", reason=reason),
            records.event(archives.join(done, list(BATCH), "left_semi"), "archive_repaired"),
            records.event(
                archives.join(damaged, list(BATCH), "left_semi"),
                "archive_repair_failed",
                error=F.lit("replacement does not read back as written"),
            ),
        ]
    if events_path:
        records.append_lines(records.audit_events(events), events_path)
    if not dry_run:
        for part in fetched:
            discard(spark, part)

    summary = archives.join(gaps.batch_gaps(lost_h, lost_s), list(BATCH), "left").join(bad, list(BATCH), "left")
    status = F.when(F.col("error").isNotNull(), "unreadable").when(F.col("n_heights").isNull(), "ok")
    if dry_run:
        status = status.otherwise("problem")
    else:
        ends = done.select(*BATCH, F.lit("repaired").alias("_end")).unionByName(
            damaged.select(*BATCH, F.lit("failed").alias("_end"))
        )
        summary = summary.join(ends, list(BATCH), "left")
        status = status.when(F.col("_end").isNotNull(), F.col("_end")).otherwise("incomplete")
    zero = F.lit(0).cast("bigint")
    return summary.select(
        "archive_key",
        "batch_start",
        "batch_end",
        F.coalesce("n_heights", zero).alias("missing_heights"),
        F.coalesce("n_shards", zero).alias("missing_shards"),
        status.alias("status"),
        "error",
    )


def validate_job(
    stored: DataFrame,
    *,
    start_from: int,
    stop_at: int,
    size: int,
    prefix: str = "archives",
    stats_path: str | None = None,
) -> DataFrame:
    """Check that every expected range has its archive.

    One row: expected and missing ranges, the first missing ones, archives that share a range,
    and stretches not covered or covered more than once. With `stats_path`, missing ranges are
    appended there as events.
    """
    if stop_at <= 0 or start_from > stop_at or size <= 0:
        raise ValueError("validation needs 0 < stop_at, start_from <= stop_at and size > 0")
    spark = stored.sparkSession
    # The inventory is read once; all checks work on its few archive rows.
    archives = materialise(parse_archives(stored, prefix).select("key", "first", "last"), "archives")
    expected = inventory.expected_batches(spark, start_from, stop_at, size)
    missing = ranges.missing_ranges(expected, ranges.first_archive(archives))
    uneven = ranges.coverage(archives, start_from, stop_at)
    if stats_path:
        records.append_lines(
            records.event(
                missing,
                "validate_ranges_missing",
                start_from=F.lit(start_from),
                stop_at=F.lit(stop_at),
                batch_dirs=F.lit(size),
                batch_start=F.col("first"),
                batch_end=F.col("last"),
                missing_range=range_name("first", "last"),
            ),
            stats_path,
        )
    return ranges.validation_summary(expected, missing).select(
        "*",
        ranges.duplicate_archives(archives).agg(F.count("*")).scalar().alias("duplicates"),
        uneven.agg(F.count_if(F.col("kind") == "gap")).scalar().alias("gaps"),
        uneven.agg(F.count_if(F.col("kind") == "overlap")).scalar().alias("overlaps"),
    )


def copy_job(
    source: DataFrame,
    dest: DataFrame,
    *,
    source_prefix: str,
    dest_prefix: str = "",
    overwrite: bool = False,
    copy_all_under_prefix: bool = False,
    after: DataFrame | None = None,
    roots: tuple[str, str] | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Counters of a copy and, against the destination `after` it, how many keys arrived intact.

    A `dry_run` copies nothing and returns the plan, ``key, dest_key, size``.

    With `roots`, the folders the source and destination keys lie in, the planned objects are
    copied, and the destination is listed afterwards. The keys themselves come from
    :func:`copying.copy_plan`, their order under a cap from :func:`copying.copy_schedule`.
    """
    if dry_run:
        plan = copying.copy_plan(source, dest, source_prefix, dest_prefix, overwrite, copy_all_under_prefix)
        return plan.select("key", "dest_key", "size")
    if roots:
        plan = copying.copy_plan(source, dest, source_prefix, dest_prefix, overwrite, copy_all_under_prefix)
        dest = materialise(dest, "dest")  # its state before the copy
        sent = materialise(transfer.copy_objects(plan, *roots), "sent")
        arrived = sent.where("verdict = 'ok'").select(F.col("dest_key").alias("key"), "size", F.col("md5").alias("etag"))
        # What a failed copy left is not the object, nor is the one it was to overwrite.
        kept = dest.join(sent.select(F.col("dest_key").alias("key")), "key", "left_anti").select("key", "size", "etag")
        after = kept.unionByName(arrived)
    counters = copying.copy_counters(source, dest, source_prefix, dest_prefix, overwrite, copy_all_under_prefix)
    whole = copying.copy_plan(source, dest, source_prefix, dest_prefix, True, copy_all_under_prefix)
    verdicts = copying.reconcile(whole, dest if after is None else after)
    kinds = ("ok", "missing", "size_mismatch", "md5_mismatch")
    counts = verdicts.agg(F.struct(*(F.count_if(F.col("verdict") == v).alias(v) for v in kinds)).alias("_v"))
    return counters.select("*", counts.scalar().alias("_v")).select(*counters.columns, "_v.*")


def exists_job(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """``FOUND`` or ``MISSING`` per key."""
    return copying.exists_keys(keys, stored)


def purge_plan_job(stored: DataFrame, prefix: str = "", page_size: int = copying.DELETE_PAGE) -> DataFrame:
    """Delete requests that would empty `prefix`: keys and bytes per page. Nothing is deleted."""
    pages = copying.sized_manifest(stored, prefix, page_size)
    return pages.groupBy("page").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))
