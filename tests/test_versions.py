"""Digests that count repeats, and tables whose batches are replaced by one commit."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import jobs
from ledgerloom.session import scratch_path
from ledgerloom.sinks import batches as sink
from ledgerloom.sinks import digests
from ledgerloom.sinks.versions import Conflict, VersionedTable

SCHEMA = "height bigint, member string, size bigint"


def objects(spark, heights, size=1, member="block.json"):
    return spark.createDataFrame([(h, member, size) for h in heights], SCHEMA)


def values(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def table_of(spark, heights=range(30)):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    table.replace(objects(spark, heights), 0, 10)
    return table


def test_repeated_rows_do_not_cancel(spark):
    rows = [[(1, m, 1) for m in names] for names in (("a", "a", "c"), ("b", "b", "c"))]
    one, two = (spark.createDataFrame(r, SCHEMA) for r in rows)
    path = scratch_path(spark, "t")
    went_in = sink.write_batches(one, path, 0, 10)
    assert sink.verify_totals(sink.read_batches(spark, path), went_in)
    assert values(sink.verify_batches(two, path, 0, 10), "ok") == [(False,)]
    assert values(sink.find_damage(two, path, 0, 10), "height", "verdict") == [(1, "changed")]
    sink.write_batches(two, path, 0, 10)
    assert not sink.verify_totals(sink.read_batches(spark, path), went_in)


def test_a_mismatch_names_the_height(spark):
    path = scratch_path(spark, "t")
    sink.write_batches(objects(spark, [*range(2000), 5000]), path, 0, 10_000)
    wanted = objects(spark, [h for h in range(2000) if h != 700]).withColumn("size", F.when(F.col("height") == 300, 2).otherwise(1).cast("bigint"))
    wanted = wanted.unionByName(objects(spark, [1_000, 9_999]))
    damage = values(sink.find_damage(wanted, path, 0, 10_000), "height", "files", "stored_files", "verdict")
    assert damage == [
        (300, 1, 1, "changed"), (700, 0, 1, "extra"), (1000, 2, 1, "changed"), (5000, 0, 1, "extra"), (9999, 1, 0, "missing"),
    ]


def test_trees_add_up_and_name_the_same_heights(spark):
    rows = sink.assign_batch(objects(spark, [*range(0, 70_000, 7), 3, 3]), 0, 1_000_000)
    changed = rows.withColumn("size", F.when(F.col("height") == 66_003, 9).otherwise(F.col("size"))).where("height <> 14")
    paths = [scratch_path(spark, "tree") for _ in range(3)]
    for path, df in zip(paths, (rows, changed, rows.repartition(5))):
        digests.write_tree(digests.height_digests(df), path)
    one, two, same = (digests.read_tree(spark, p) for p in paths)
    sums = one.groupBy("level").agg(F.sum("files"), F.sum("digest").cast("string"), F.count("*")).collect()
    assert len({(r[1], r[2]) for r in sums}) == 1 and len(sums) == digests.LEVELS + 1
    assert next(r[3] for r in sums if r.level == digests.LEVELS) == 1
    assert values(digests.damaged_in_trees(one, two), "height", "verdict") == [(14, "missing"), (66_003, "changed")]
    assert digests.damaged_in_trees(one, same).isEmpty()


def test_replacing_batches_keeps_the_others_and_the_past(spark):
    table = table_of(spark)
    assert table.replace(objects(spark, [10, 11], 7), 0, 10) == 2
    assert values(table.read().groupBy("batch_start").agg(F.sum("size"))) == [(0, 10), (10, 14), (20, 10)]
    assert values(table.read(at=1).groupBy("batch_start").agg(F.sum("size"))) == [(0, 10), (10, 10), (20, 10)]
    assert table.read().columns == [*objects(spark, [1]).columns, "batch_start", "batch_end"]
    assert "version" in table.read().where("batch_start = 10")._jdf.queryExecution().optimizedPlan().toString()


def test_a_killed_replacement_leaves_the_old_table(spark):
    table = table_of(spark)
    before = values(table.read())
    table.stage(objects(spark, range(10), 5), 0, 10)  # written, never committed
    assert values(VersionedTable(spark, table.path).read()) == before
    with open(f"{table.path}/commits/000000000002", "w") as cut_short:
        cut_short.write('{"snap')
    assert values(table.read()) == before and table.head() == 1
    assert table.replace(objects(spark, range(10), 6), 0, 10) == 3
    assert values(table.read().groupBy("batch_start").agg(F.sum("size"))) == [(0, 60), (10, 10), (20, 10)]


def test_a_reader_sees_one_version(spark):
    table = table_of(spark)
    reader = table.read()
    table.replace(objects(spark, range(10, 20), 5), 0, 10)
    assert values(reader.groupBy("batch_start").agg(F.sum("size"))) == [(0, 10), (10, 10), (20, 10)]


def test_writers_of_other_batches_get_along_and_others_conflict(spark):
    table = table_of(spark)
    one, two, three = (table.stage(objects(spark, [h], s), 0, 10) for h, s in ((0, 2), (10, 3), (0, 4)))
    assert [table.commit(one), table.commit(two)] == [2, 3]
    with pytest.raises(Conflict):
        table.commit(three)
    assert values(table.read().groupBy("batch_start").agg(F.sum("size"))) == [(0, 2), (10, 3), (20, 10)]
    assert table.forget(three) == 1


def test_vacuum_removes_what_nobody_points_to(spark):
    table = table_of(spark)
    table.replace(objects(spark, range(10), 5), 0, 10)
    table.stage(objects(spark, range(20, 30), 5), 0, 10)
    assert table.vacuum() == 0  # all of it is young
    time.sleep(1.1)
    assert table.vacuum(grace_sec=0.5) == 2  # the first version of batch 0, and what was never committed
    assert list(table.commits()) == [2]
    assert values(table.read().groupBy("batch_start").agg(F.sum("size"))) == [(0, 50), (10, 10), (20, 10)]


def test_digest_trees_find_damage_in_stored_files(spark):
    table = table_of(spark)
    number = table.write_digests()
    assert table.audit(number).isEmpty()
    lost = next(f for f in table.read().where("batch_start = 20").inputFiles() if "batch_start=20" in f)
    os.remove(lost.removeprefix("file://"))
    assert values(table.audit(number), "height", "verdict") == [(h, "missing") for h in range(20, 30)]


MEMBERS = "batch_start bigint, batch_end bigint, parent string, height bigint, member string, size bigint, payload string"
HEADER = '{"chunks":[]}'


def test_one_bad_archive_does_not_stop_a_repair(spark, monkeypatch):
    rows = [(b, b + 9, "d", h, "block.json", 3, HEADER) for b in (0, 10, 20) for h in range(b, b + 10) if h % 10 != 4]
    table = VersionedTable(spark, scratch_path(spark, "repair"))
    table.replace(spark.createDataFrame(rows, MEMBERS))
    stage = table.stage

    def loses_a_file(*args, **kw):
        staged = stage(*args, **kw)
        damaged = f"{table.path}/data/batch_start=10/batch_end=19/version={staged.version}"
        for name in os.listdir(damaged):
            if name.endswith(".parquet"):
                os.replace(f"{damaged}/{name}", f"{damaged}/_{name}")
        return staged

    monkeypatch.setattr(table, "stage", loses_a_file)
    # Archive 10 looks complete to the gate; only the comparison with what went in finds it out.
    monkeypatch.setattr(jobs.gaps, "missing_in_batches", _without(jobs.gaps.missing_in_batches))
    fetched = [(h, "block.json", 3, HEADER) for h in (4, 14)]
    events = scratch_path(spark, "events")
    summary = jobs.audit_repair_job(
        spark.createDataFrame([(f"archives/{b}-{b + 9}.tar.zst", 1) for b in (0, 10, 20)], "key string, size bigint"),
        table.read(),
        spark.createDataFrame(fetched, "height bigint, member string, size bigint, payload string"),
        table,
        events_path=events,
    )
    assert values(summary, "batch_start", "status") == [(0, "repaired"), (10, "failed"), (20, "incomplete")]
    assert values(table.read().groupBy("batch_start").count()) == [(0, 10), (10, 9), (20, 9)]
    kinds = values(spark.read.json(events).where("kind like 'archive_rep%'"), "kind", "batch_start")
    assert kinds == [("archive_repair_failed", 10), ("archive_repair_skipped_incomplete", 20), ("archive_repaired", 0)]


def _without(find):
    """The gap scan, blind to archive 10 once it is looked at again."""

    def scan(batches, objects, keep=()):
        found = find(batches, objects, keep)
        return found if "archive_key" in batches.columns else found.where("batch_start <> 10")

    return scan


def test_a_repair_reads_the_wanted_heights_of_the_fallback_once(spark, monkeypatch):
    rows = [(b, b + 9, "d", h, "block.json", 3, HEADER) for b in (0, 10) for h in range(b, b + 10) if h != 4]
    table = VersionedTable(spark, scratch_path(spark, "repair"))
    table.replace(spark.createDataFrame(rows, MEMBERS))
    copies, keep = [], jobs.materialise

    def seen(df, name, into=None):
        out = keep(df, name, into)
        if name == "fetched":
            copies.append(values(out, "height"))
        return out

    monkeypatch.setattr(jobs, "materialise", seen)
    fallback = [(h, "block.json", 3, HEADER) for h in range(20)]
    summary = jobs.audit_repair_job(
        spark.createDataFrame([(f"archives/{b}-{b + 9}.tar.zst", 1) for b in (0, 10)], "key string, size bigint"),
        table.read(),
        spark.createDataFrame(fallback, "height bigint, member string, size bigint, payload string"),
        table,
    )
    assert values(summary, "batch_start", "status") == [(0, "repaired"), (10, "ok")]
    assert copies == [[(4,)]]
    assert table.read().count() == 20
