"""Whole jobs on small literal tables."""

import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import jobs
from ledgerloom.session import scratch_path, shared_dir
from ledgerloom.sinks import archives as tar_sink
from ledgerloom.sinks import batches as sink
from ledgerloom.sinks import transfer
from ledgerloom.sources import inventory

OBJECTS = "source string, priority int, height bigint, member string, size bigint, payload string"
STORED = "key string, size bigint"


def objects(spark, rows):
    return spark.createDataFrame(rows, OBJECTS)


def listing(spark, heights, priority=1):
    return [(f"s{priority}", priority, h, "block.json", 2, '{"chunks":[]}') for h in heights]


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def stored(spark, *keys):
    return spark.createDataFrame([(k, 1) for k in keys], STORED)


def test_archive_job_seals_resumes_and_keeps_partial_batches_open(spark):
    folder = scratch_path(spark, "job")
    out, control = f"{folder}/out", f"{folder}/control"
    source = objects(spark, listing(spark, [*range(0, 18), *range(25, 45)]) + listing(spark, range(10, 20), 2))
    fallback = objects(spark, listing(spark, [20, 21], 9))
    head = lambda h: spark.createDataFrame([(h,)], "latest bigint")

    def run(latest, control_table=None, keys=()):
        return jobs.archive_job(
            source, stored(spark, *keys), out, start_from=0, size=10, latest=head(latest), hot=3, fallback=fallback,
            control=control_table, control_path=control, stats_path=f"{folder}/stats",
        )

    assert rows(run(12)) == []  # ten heights are safe only from 13 on
    first = run(34)
    assert rows(first, "batch_start", "dirs", "empty_heights", "status") == [
        (0, 10, 0, "archived"),
        (10, 10, 0, "archived"),
        (20, 7, 3, "archived"),
    ]
    done = spark.read.parquet(control)
    assert inventory.resume_point(done, 0).first()[0] == 30
    assert sink.read_batches(spark, out).where("height in (20, 21)").select("source").distinct().first()[0] == "s9"
    assert sink.read_batches(spark, out).where("height = 18").first().priority == 2

    second = run(43, done)
    assert rows(second, "batch_start", "dirs") == [(30, 10)]
    assert sink.read_batches(spark, out).count() == 37
    lines = spark.read.json(f"{folder}/stats")
    assert lines.count() == 4 and lines.where("run_sec is null or compressed_mb is null").count() == 0

    # Stored batches count as archives: nothing is pending, and only the open end is missing.
    listed = sink.batch_inventory(spark, out)
    assert jobs.pending_work(spark, listed, 0, 39, 10).count() == 0
    check = jobs.validate_job(listed, start_from=0, stop_at=44, size=10).first()
    assert (check.expected, check.missing, check.first_missing, check.gaps) == (5, 1, "40-44", 1)


def test_archive_job_skips_stored_batches_and_reports_empty_ones(spark):
    out = scratch_path(spark, "job")
    source = objects(spark, listing(spark, [*range(0, 10), *range(20, 30)]))
    summary = jobs.archive_job(
        source, stored(spark, "archives/0-9.tar.zst"), out, start_from=0, size=10, stop_at=35
    )
    assert rows(summary, "batch_start", "files", "status") == [(10, 0, "empty"), (20, 10, "archived")]
    assert rows(sink.read_batches(spark, out), "batch_start") == [(20,)] * 10


def test_archive_job_stops_after_a_run_of_empty_heights(spark):
    source = objects(spark, listing(spark, [*range(0, 10), *range(18, 30), *range(45, 60)]))
    plan = dict(start_from=0, size=10, stop_at=59)
    dry = jobs.archive_job(source, stored(spark), "unused", **plan, consecutive_empty=9, dry_run=True)
    assert rows(dry, "batch_start", "status") == [(b, "pending") for b in (0, 10, 20, 30)]
    everything = jobs.archive_job(source, stored(spark), "unused", **plan, consecutive_empty=16, dry_run=True)
    assert everything.count() == 6


def test_boundary_of_zero_seals_nothing(spark):
    head = spark.createDataFrame([(5,)], "latest bigint")
    source = objects(spark, listing(spark, range(6)))
    summary = jobs.archive_job(source, stored(spark), scratch_path(spark, "job"), start_from=0, size=1, latest=head, hot=9)
    assert summary.count() == 0


def test_stage_job_skips_full_copies_and_refetches_empty_ones(spark):
    out = scratch_path(spark, "stage")
    source = objects(spark, listing(spark, range(0, 4)) + listing(spark, [0, 5], 2))
    local = spark.createDataFrame([(0, "block.json", 7), (1, "block.json", 0)], "height bigint, member string, size bigint")
    summary = jobs.stage_job(source, local, out, start_from=0, stop_at=4, size=10, stats_path=f"{out}-stats")
    assert rows(summary) == [(0, 9, 4, 3, 1, 6, 7)]
    assert rows(sink.read_batches(spark, out), "height", "source") == [(1, "s1"), (2, "s1"), (3, "s1")]
    line = json.loads(spark.read.text(f"{out}-stats").first()[0])
    assert line["kind"] == "download_batch" and line["dirs_downloaded"] == 4
    again = jobs.stage_job(source, sink.read_batches(spark, out), out, start_from=0, stop_at=4, size=10)
    assert rows(again, "files_fetched", "files_skipped") == [(1, 3)]
    assert sink.read_batches(spark, out).count() == 4


BATCHED = "batch_start bigint, batch_end bigint, parent string, height bigint, member string, size bigint, payload string"


def test_fix_gaps_job(spark):
    folder = scratch_path(spark, "gaps")
    names = spark.createDataFrame([("batch_0_4",), ("batch_5_9",), ("batch_10_11",), ("junk",)], "name string")
    have = [(0, 4, "p", h, "block.json", 1, "{}") for h in (0, 1, 3)]
    have += [(5, 9, "p" if h % 2 else "q", h, "block.json", 1, "{}") for h in (5, 6, 7)]
    members = spark.createDataFrame(have, BATCHED)
    fallback = objects(spark, [("f", 3, h, m, 1, '{"a":1}') for h in (2, 11) for m in ("block.json", "shard_0.json")])
    arguments = dict(base_url="https://api.example.org/b", events_path=f"{folder}/events")
    totals = jobs.fix_gaps_job(names, members, fallback, f"{folder}/out", **arguments)
    assert rows(totals.where("found > 0")) == [(0, 4, 2, 1, 1), (10, 11, 2, 1, 1)]
    filled = sink.read_batches(spark, f"{folder}/out")
    assert rows(filled, "height", "parent", "member") == [
        (2, "p", "block.json"), (2, "p", "shard_0.json"), (11, "", "block.json"), (11, "", "shard_0.json"),
    ]
    events = spark.read.json(f"{folder}/events")
    kinds = dict(rows(events.groupBy("kind").count()))
    assert kinds == {"gap_found": 4, "gap_filled": 2, "fallback_not_found": 2, "archive_problem": 1}
    assert rows(events.where("kind = 'gap_filled'"), "dest_dir") == [
        ("batch_0_4/p/000000000002",), ("batch_10_11/000000000011",),
    ]
    dry = jobs.fix_gaps_job(names, members, fallback, dry_run=True, events_path=f"{folder}/dry")
    assert rows(dry.where("found > 0")) == [(0, 4, 2, 0, 0), (10, 11, 2, 0, 0)]
    assert set(rows(spark.read.json(f"{folder}/dry").where("kind = 'gap_found'"), "dry_run")) == {(True,)}


def header(*ids):
    return json.dumps({"chunks": [{"shard_id": i} for i in ids]})


def audit_tables(spark, path):
    def archive(start, end, skip=(), bad=None, parent="p"):
        out = []
        for h in range(start, end + 1):
            if h not in skip:
                out.append((start, end, parent, h, "block.json", 5, bad if bad and h == start else header(0, 1)))
                out += [(start, end, parent, h, f"shard_{s}.json", 1, "{}") for s in (0, 1)]
        return out

    members = archive(0, 4)
    members += archive(5, 9, skip=[7])  # an absent height the fallback has
    members += [r for r in archive(10, 14) if r[3:5] != (12, "shard_1.json")]  # an absent shard it has
    members += archive(15, 19, skip=[16, 17])  # one of the two heights it has
    members += archive(20, 24, bad="nonsense")
    members += archive(25, 29)[:3] + archive(25, 29, parent="q")[3:]
    members += archive(100, 104, skip=[100, 101])  # out of scope
    sink.write_batches(spark.createDataFrame(members, BATCHED), path)
    fallback = [("f", 3, h, "block.json", 5, header(0, 1)) for h in (7, 12, 16)]
    fallback += [("f", 3, h, f"shard_{s}.json", 9, "{}") for h in (7, 12, 16) for s in (0, 1)]
    keys = [f"archives/{a}-{a + 4}.tar.zst" for a in (0, 5, 10, 15, 20, 25, 100)]
    return stored(spark, *keys, "archives/30-34.tar.gz"), objects(spark, fallback).drop("source", "priority")


def test_audit_and_repair_job(spark):
    folder = scratch_path(spark, "audit")
    path = f"{folder}/batches"
    keys, fallback = audit_tables(spark, path)
    lost = spark.createDataFrame([(30, "extract: broken")], "batch_start bigint, error string")
    arguments = dict(stop_at=50, unreadable=lost, base_url="https://api.example.org/b")

    dry = jobs.audit_repair_job(keys, sink.read_batches(spark, path), fallback, path, **arguments, dry_run=True,
                                events_path=f"{folder}/dry")
    assert rows(dry, "batch_start", "missing_heights", "missing_shards", "status") == [
        (0, 0, 0, "ok"), (5, 1, 0, "problem"), (10, 0, 1, "problem"), (15, 2, 0, "problem"),
        (20, 0, 0, "unreadable"), (25, 0, 0, "unreadable"), (30, 0, 0, "unreadable"),
    ]
    assert spark.read.json(f"{folder}/dry").where("kind = 'archive_problem'").count() == 4 + 3
    untouched = sink.read_batches(spark, path).count()

    summary = jobs.audit_repair_job(keys, sink.read_batches(spark, path), fallback, path, **arguments,
                                    events_path=f"{folder}/events")
    assert rows(summary, "batch_start", "status") == [
        (0, "ok"), (5, "repaired"), (10, "repaired"), (15, "incomplete"),
        (20, "unreadable"), (25, "unreadable"), (30, "unreadable"),
    ]
    assert dict(rows(summary, "batch_start", "error"))[20] == "shard scan: malformed block header"
    after = sink.read_batches(spark, path)
    assert after.count() == untouched + 3 + 1
    assert rows(after.where("height = 7"), "parent", "member", "size") == [
        ("p", "block.json", 5), ("p", "shard_0.json", 9), ("p", "shard_1.json", 9),
    ]
    assert after.where("height = 16").count() == 0  # the gate keeps incomplete batches out
    events = spark.read.json(f"{folder}/events")
    kinds = dict(rows(events.groupBy("kind").count()))
    assert kinds == {
        "archive_problem": 7, "archive_repair_failed": 3, "fallback_not_found": 1,
        "archive_repair_skipped_incomplete": 1, "archive_repaired": 2,
    }
    assert rows(events.where("kind = 'fallback_not_found'"), "height", "fallback_url") == [
        (17, "https://api.example.org/b/17"),
    ]
    again = jobs.audit_repair_job(keys, sink.read_batches(spark, path), fallback, path, **arguments)
    assert rows(again, "batch_start", "status")[:3] == [(0, "ok"), (5, "ok"), (10, "ok")]


def test_validate_job(spark):
    path = scratch_path(spark, "stats")
    keys = stored(spark, "archives/0-9.tar.gz", "archives/0-9.tar.zst", "archives/21-29.tar.gz", "archives/README")
    summary = jobs.validate_job(keys, start_from=0, stop_at=34, size=10, stats_path=path)
    assert summary.first().asDict() == {
        "expected": 4, "missing": 3, "first_missing": "10-19,20-29,30-34", "duplicates": 2, "gaps": 2, "overlaps": 1,
    }
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert sorted(x["missing_range"] for x in lines) == ["10-19", "20-29", "30-34"]
    assert {(x["start_from"], x["stop_at"], x["batch_dirs"]) for x in lines} == {(0, 34, 10)}
    for bad in (dict(start_from=5, stop_at=4, size=1), dict(start_from=0, stop_at=0, size=1), dict(start_from=0, stop_at=4, size=0)):
        with pytest.raises(ValueError):
            jobs.validate_job(keys, **bad)


def test_copy_exists_and_purge(spark):
    source = spark.createDataFrame([("in/0-9.tar.gz", 5, None), ("in/x", 1, None)], "key string, size bigint, etag string")
    dest = spark.createDataFrame([("out/0-9.tar.gz", 5, None)], "key string, size bigint, etag string")
    empty = dest.where("false")
    row = jobs.copy_job(source, empty, source_prefix="in", dest_prefix="out", after=dest).first().asDict()
    assert row == {
        "listed": 2, "skipped_filter": 1, "skipped_existing": 0, "copied": 1,
        "ok": 1, "missing": 0, "size_mismatch": 0, "md5_mismatch": 0,
    }
    assert rows(jobs.exists_job(spark.createDataFrame([("in/x",), ("no",)], "key string"), source)) == [
        ("in/x", "FOUND"), ("no", "MISSING"),
    ]
    assert rows(jobs.purge_plan_job(source, "in/", 1), "objects") == [(1,), (1,)]


def test_copying_objects(spark, tmp_path):
    import hashlib

    (tmp_path / "in").mkdir()
    content = {"0-9.tar.gz": b"abc", "10-19.tar.gz": b"x" * 10_000_000, "20-29.tar.gz": b"", "30-39.tar.gz": b"abc"}
    for name, data in content.items():
        (tmp_path / "in" / name).write_bytes(data)
    md5 = {k: hashlib.md5(v).hexdigest() for k, v in content.items()}
    listed = [(f"in/{k}", len(v), f'"{md5[k]}"') for k, v in content.items()]
    listed[0] = (listed[0][0], 4, None)  # the listing names another size
    listed[3] = (listed[3][0], 3, "0" * 32)  # and another digest
    listed.append(("in/40-49.tar.gz", 1, None))  # gone since it was listed
    source = spark.createDataFrame(listed, "key string, size bigint, etag string")
    dest = source.where("false")
    row = jobs.copy_job(
        source, dest, source_prefix="in", dest_prefix="out", roots=(str(tmp_path), str(tmp_path / "dest"))
    ).first()
    assert (row.copied, row.ok, row.missing) == (5, 2, 3)
    for name in ("10-19.tar.gz", "20-29.tar.gz"):
        assert (tmp_path / "dest" / "out" / name).read_bytes() == content[name]
    plan = source.withColumn("dest_key", F.col("key"))
    sent = transfer.copy_objects(plan, str(tmp_path), str(tmp_path / "again"), tasks=2)
    assert rows(sent, "key", "verdict") == [
        ("in/0-9.tar.gz", "size_mismatch"), ("in/10-19.tar.gz", "ok"), ("in/20-29.tar.gz", "ok"),
        ("in/30-39.tar.gz", "md5_mismatch"), ("in/40-49.tar.gz", "error"),
    ]


def test_import_then_audit(spark, tmp_path):
    members = spark.createDataFrame(
        [(h, m, header(0) if m == "block.json" else "{}") for h in range(20) for m in ("block.json", "shard_0.json")
         if (h, m) not in {(3, "block.json"), (14, "shard_0.json")}],
        "height bigint, member string, payload string",
    )
    staged = tar_sink.pack_archives(members, str(tmp_path / "packed"), 0, 10, "gzip")
    (tmp_path / "store" / "archives").mkdir(parents=True)
    for r in staged.collect():
        name = r.path.rpartition("/")[2]
        (tmp_path / "store" / "archives" / name).write_bytes(open(r.path.removeprefix("file:"), "rb").read())
    (tmp_path / "store" / "archives" / "0-9.tar.zst").write_bytes(b"second copy, listed later")
    (tmp_path / "store" / "archives" / "20-29.tar.zst").write_bytes(b"broken")
    store, table = str(tmp_path / "store"), str(tmp_path / "table")
    failed = jobs.import_job(spark, store, table)
    assert rows(failed, "batch_start") == [(20,)]
    keys = inventory.scan_inventory(spark, store, "archives/", "binaryFile")
    summary = jobs.audit_repair_job(
        keys, sink.read_batches(spark, table), members.withColumn("size", F.lit(1)).where("false"), table,
        unreadable=failed, dry_run=True,
    )
    assert rows(summary, "batch_start", "missing_heights", "missing_shards", "status") == [
        (0, 1, 0, "problem"), (10, 0, 1, "problem"), (20, 0, 0, "unreadable"),
    ]


def test_members_outside_height_folders_stay_with_their_archive(spark, tmp_path):
    members = [("0000004/block.json", b'{"chunks":[]}'), ("README", b"x"), ("block.json", b"y")]
    os.makedirs(tmp_path / "archives")
    with tarfile.open(tmp_path / "archives/0-9.tar.gz", "w:gz") as out:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    table = scratch_path(spark, "strays")
    assert jobs.import_job(spark, str(tmp_path), table, width=7).isEmpty()
    rows = sink.read_batches(spark, table)
    got = sorted((r.member, r.height, r.payload) for r in rows.collect() if r.height is None) + [
        (r.member, r.height, r.payload) for r in rows.where("height is not null").collect()
    ]
    assert got == [("README", None, "x"), ("block.json", None, "y"), ("block.json", 4, '{"chunks":[]}')]


def test_packed_ranges_have_times_and_lines(spark):
    rows = spark.createDataFrame([(h, "block.json", "x" * 3000) for h in range(25)], "height bigint, member string, payload string")
    folder = scratch_path(spark, "packed")
    done = jobs.pack_job(rows, folder, start_from=0, size=10, stats_path=f"{folder}-stats").orderBy("batch_start").collect()
    assert [(r.batch_start, r.members, r.dirs, r.bytes) for r in done] == [(0, 10, 10, 30_000), (10, 10, 10, 30_000), (20, 5, 5, 15_000)]
    assert all(0 < r.stored < r.bytes and r.compress_sec > 0 and r.upload_sec > 0 and r.download_sec >= 0 for r in done)
    lines = spark.read.json(f"{folder}-stats").orderBy("batch").collect()
    assert [r.batch for r in lines] == ["0-9", "10-19", "20-29"] and all(r.reduction_pct > 50 for r in lines)


def test_broken_replies_fill_nothing_and_say_why(spark):
    names = spark.createDataFrame([("batch_0_4",)], "name string")
    have = spark.createDataFrame([(0, 4, "d", 0, "block.json", 3)], "batch_start bigint, batch_end bigint, parent string, height bigint, member string, size bigint")
    bodies = [
        (1, '{"block":{"a":1},"shards":[{"shard_id":0}]}'), (2, '{"block":{"a":1},"shards":[{"id":0}]}'),
        (3, '{"block":{},"shards":[]}'), (0, "not asked for"),
    ]
    folder = scratch_path(spark, "replies")
    totals = jobs.fix_gaps_job(
        names, have, None, f"{folder}/out", replies=spark.createDataFrame(bodies, "height bigint, body string"), events_path=f"{folder}/events"
    )
    assert sorted(map(tuple, totals.select("found", "filled", "failed").collect())) == [(4, 1, 3)]
    filled = sink.read_batches(spark, f"{folder}/out")
    assert sorted((r.height, r.member) for r in filled.collect()) == [(1, "block.json"), (1, "shard_0.json")]
    events = spark.read.json(f"{folder}/events")
    failed = {r.height: r.error for r in events.where("kind = 'gap_fill_failed'").collect()}
    assert set(failed) == {2, 3} and "shard_id" in failed[2] and "block" in failed[3]
    assert [r.height for r in events.where("kind = 'fallback_not_found'").collect()] == [4]


def test_copies_of_payload_do_not_stay_in_the_shared_folder(spark, tmp_path):
    shared = shared_dir(spark)
    rows = spark.createDataFrame([(h, "block.json", "x" * 30) for h in range(25)], "height bigint, member string, payload string")
    folder = scratch_path(spark, "packed")
    jobs.pack_job(rows, folder, start_from=0, size=10)
    before = set(os.listdir(shared))
    table = scratch_path(spark, "imported")
    jobs.import_job(spark, folder, table, prefix=None)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert left == {"imported", "failed"}
    before = set(os.listdir(shared))
    for _ in range(2):
        sink.merge_heights(spark.createDataFrame([(4, "block.json", 1)], "height bigint, member string, size bigint"), f"{table}-merged", 0, 10)
    assert set(os.listdir(shared)) - before == {os.path.basename(f"{table}-merged")}
