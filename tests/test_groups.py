"""Writes of very many batches: folders of neighbours instead of one each."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sinks import batches as sink
from ledgerloom.sinks import groups
from ledgerloom.sinks.versions import VersionedTable

MANY = 40


@pytest.fixture(autouse=True)
def few_folders(monkeypatch):
    monkeypatch.setattr(groups, "FOLDERS", 20)
    monkeypatch.setattr(groups, "GROUPS", 5)


def objects(spark, heights, size=1):
    heights = range(heights) if isinstance(heights, int) else heights
    return spark.createDataFrame([(h, "block.json", size) for h in heights], "height bigint, member string, size bigint")


def files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path.removeprefix("file://")) for name in names)


def sizes(rows):
    return {r.batch_start: r.s for r in rows.groupBy("batch_start").agg(F.sum("size").alias("s")).collect()}


def test_many_batches_share_folders_and_are_replaced_alone(spark):
    path = scratch_path(spark, "t")
    went_in = sink.write_batches(objects(spark, 2 * MANY), path, 0, 2)
    assert files(path) == groups.GROUPS
    assert sink.verify_totals(sink.read_batches(spark, path), went_in)
    assert sink.read_batches(spark, path).columns == ["height", "member", "size", "batch_start", "batch_end"]
    # Of batch 20 nothing but the new row stays; 900 is new and far from all others.
    went_in = sink.replace_batches(objects(spark, [21, 900], 5), path, 0, 2)
    assert (went_in["files"], went_in["bytes"]) == (2, 10)
    expected = {b: 2 for b in range(0, 2 * MANY, 2)} | {20: 5, 900: 5}
    assert sizes(sink.read_batches(spark, path)) == expected
    fresh = sink.read_batches(spark, path).where("batch_start in (20, 900)")
    assert sink.verify_totals(fresh, went_in)
    assert sink.read_batches(spark, path).where("batch_end <> batch_start + 1").isEmpty()


def test_neighbours_keep_columns_that_a_replacement_lacks(spark):
    path = scratch_path(spark, "t")
    sink.replace_batches(objects(spark, MANY).withColumn("source", F.lit("s")), path)
    sink.replace_batches(objects(spark, [7], 3), path)
    stored = sink.read_batches(spark, path)
    assert stored.where("source = 's'").count() == MANY - 1
    assert [(r.height, r.size) for r in stored.where("source is null").collect()] == [(7, 3)]


def test_rows_are_appended_and_merged_into_groups(spark):
    path = scratch_path(spark, "t")
    sink.write_heights(objects(spark, MANY), path)
    sink.write_heights(objects(spark, [3, MANY]), path, append=True)
    assert sink.read_batches(spark, path).count() == MANY + 2
    sink.merge_heights(objects(spark, [3, 5], 4), path)
    assert sizes(sink.read_batches(spark, path)) == {h: 1 for h in range(MANY + 1)} | {3: 4, 5: 4}


def test_an_inventory_of_shared_files_has_every_batch_and_all_bytes(spark):
    path = scratch_path(spark, "t")
    sink.write_batches(objects(spark, 2 * MANY), path, 0, 2)
    listed = sink.batch_inventory(spark, path)
    stored = sum(os.path.getsize(f.removeprefix("file://")) for f in sink.read_batches(spark, path).inputFiles())
    assert listed.agg(F.count("*"), F.sum("size")).first() == (MANY, stored)
    assert {(r.batch_start, r.batch_end) for r in listed.collect()} == {(b, b + 1) for b in range(0, 2 * MANY, 2)}
    assert sink.batch_inventory(spark, path, between=(10, 20)).count() == 6


def test_a_row_without_a_height_stays_readable(spark):
    path = scratch_path(spark, "t")
    rows = objects(spark, MANY)
    sink.write_batches(rows.unionByName(rows.limit(1).withColumn("height", F.lit(None).cast("bigint"))), path)
    assert sink.read_batches(spark, path).where("batch_start is null").count() == 1


@pytest.mark.parametrize("first", [MANY, 8])
def test_versions_of_many_and_few_batches_lie_side_by_side(spark, first):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    table.replace(objects(spark, first))
    assert len(table.read().inputFiles()) < groups.FOLDERS
    second = MANY if first == 8 else 8
    table.replace(objects(spark, second, 2))
    replaced = {h: 2 for h in range(second)}
    assert sizes(table.read()) == {h: 1 for h in range(first)} | replaced
    assert sizes(table.read(at=1)) == {h: 1 for h in range(first)}
    staged = table.stage(objects(spark, MANY, 3))
    table.commit(staged, spark.createDataFrame([(5, 5)], "batch_start bigint, batch_end bigint"))
    assert sizes(table.read()) == {h: 1 for h in range(first)} | replaced | {5: 3}
    # The folder of height 5 is named for its sake and holds more; all others of that version go.
    kept = files(table.path)
    assert table.forget(staged) == groups.GROUPS - 1 and files(table.path) < kept
    assert sizes(table.read()) == {h: 1 for h in range(first)} | replaced | {5: 3}
    assert table.read().columns == ["height", "member", "size", "batch_start", "batch_end"]


def test_vacuum_keeps_a_group_that_one_batch_still_needs(spark):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    table.replace(objects(spark, MANY))
    table.replace(objects(spark, [h for h in range(MANY) if h != 9], 2))
    assert table.vacuum(grace_sec=-1) == groups.GROUPS - 1
    assert sizes(table.read()) == {h: 2 for h in range(MANY)} | {9: 1}
