"""Archives of one start, unusable fetched blocks, repeated keys, replaced rows, spread domains."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerloom.operators import copying, gaps, ranges, stats
from ledgerloom.plans import jobs
from ledgerloom.session import discard, exists, qualified, scratch_path
from ledgerloom.sinks import batches as sink
from oracle import compare

MEMBERS = "batch_start bigint, batch_end bigint, parent string, height bigint, member string, size bigint, payload string"
FALLBACK = "height bigint, member string, size bigint, payload string"
HEADER = '{"chunks":[]}'


def values(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def blocks(first, last, heights):
    return [(first, last, "d", h, "block.json", 3, HEADER) for h in heights]


def audit(spark, rows, fallback, keys=("archives/0-9.tar.zst", "archives/0-19.tar.zst")):
    folder = scratch_path(spark, "audit")
    sink.write_batches(spark.createDataFrame(rows, MEMBERS), f"{folder}/batches")
    stored = spark.createDataFrame([(k, 1) for k in keys], "key string, size bigint")
    summary = jobs.audit_repair_job(
        stored,
        sink.read_batches(spark, f"{folder}/batches"),
        spark.createDataFrame(fallback, FALLBACK),
        f"{folder}/batches",
        events_path=f"{folder}/events",
    )
    kinds = {r.kind for r in spark.read.json(f"{folder}/events").select("kind").collect()}
    return values(summary, "batch_end", "missing_heights", "status"), sink.read_batches(spark, f"{folder}/batches"), kinds


def test_archives_of_one_start_are_told_apart(spark):
    rows = blocks(0, 9, range(10)) + blocks(0, 19, [h for h in range(20) if h != 15])
    summary, back, _ = audit(spark, rows, [(15, "block.json", 3, HEADER)])
    assert summary == [(9, 0, "ok"), (19, 1, "repaired")]
    assert back.where("batch_end = 9").count() == 10 and back.where("batch_end = 19").count() == 20


def test_repair_keeps_rows_outside_the_range(spark):
    rows = blocks(0, 9, [0, 1, 2, 3, 4, 5, 6, 7, 8, 55])
    summary, back, _ = audit(spark, rows, [(9, "block.json", 3, HEADER)], ["archives/0-9.tar.zst"])
    assert summary == [(9, 1, "repaired")]
    assert [r.height for r in back.orderBy("height").collect()] == [*range(10), 55]


@pytest.mark.parametrize("size, payload", [(3, "{}"), (3, "null"), (0, HEADER), (3, None)])
def test_unusable_blocks_fill_nothing(spark, size, payload):
    bad = [(9, "block.json", size, payload), (9, "shard_0.json", 3, "{}")]
    summary, back, kinds = audit(spark, blocks(0, 9, range(9)), bad, ["archives/0-9.tar.zst"])
    assert summary == [(9, 1, "incomplete")] and back.count() == 9
    assert "gap_fill_failed" in kinds and "archive_repair_skipped_incomplete" in kinds
    source = spark.createDataFrame([(1, h, "block.json", 3, HEADER) for h in range(9)], "priority int, " + FALLBACK)
    fallback = spark.createDataFrame([(9, *r) for r in bad], "priority int, " + FALLBACK)
    stored = spark.createDataFrame([], "key string, size bigint")
    out = scratch_path(spark, "out")
    done = jobs.archive_job(source, stored, out, start_from=0, stop_at=9, size=10, fallback=fallback)
    assert values(done, "dirs", "empty_heights") == [(9, 1)]


def test_fixed_gaps_replace_and_do_not_repeat(spark):
    names = spark.createDataFrame([("batch_0_3",)], "name string")
    have = spark.createDataFrame(blocks(0, 3, [0]), MEMBERS)
    fetched = [(1, "block.json", 3, HEADER), (2, "block.json", 0, ""), (3, "shard_0.json", 3, "{}")]
    out = scratch_path(spark, "gaps")
    for _ in range(2):
        totals = jobs.fix_gaps_job(names, have, spark.createDataFrame(fetched, FALLBACK), out)
        assert values(totals, "found", "filled", "failed") == [(3, 1, 2)]
    assert values(sink.read_batches(spark, out), "height", "member") == [(1, "block.json")]


def test_staging_replaces_empty_copies(spark):
    out = scratch_path(spark, "stage")
    schema = "source string, priority int, height bigint, member string, size bigint"
    sink.write_heights(spark.createDataFrame([("s", 1, 4, "block.json", 0), ("s", 1, 5, "block.json", 2)], schema), out, 0, 10)
    source = spark.createDataFrame([("s", 1, 4, "block.json", 7), ("s", 1, 5, "block.json", 7)], schema)
    jobs.stage_job(source, sink.read_batches(spark, out), out, start_from=0, stop_at=9, size=10)
    assert values(sink.read_batches(spark, out), "height", "size") == [(4, 7), (5, 2)]


def test_repeated_keys_count_once(spark):
    source = spark.createDataFrame([("a/x", 1, "e")], "key string, size bigint, etag string")
    dest = spark.createDataFrame([("b/x", 1, "e"), ("b/x", 1, "e")], "key string, size bigint, etag string")
    assert copying.copy_counters(source, dest, "a/", "b/", copy_all_under_prefix=True).first().listed == 1
    assert values(copying.exists_keys(dest.select("key").distinct(), dest)) == [("b/x", "FOUND")]
    assert values(copying.reconcile(source.withColumn("dest_key", F.lit("b/x")), dest)) == [("b/x", "ok")]
    local = spark.createDataFrame([(1, "m", 5), (1, "m", 5)], "height bigint, member string, size bigint")
    assert values(stats.fetch_stats(local.limit(1), local)) == [(1, 0, 1, 0, 5)]


def test_a_few_long_batches_are_the_work_of_many_tasks(spark):
    long = spark.createDataFrame([(0, 299_999)], "batch_start bigint, batch_end bigint").coalesce(1)
    heights = ranges.batch_heights(long)
    assert heights.count() == heights.select("height").distinct().count() == 300_000
    assert heights.select(F.spark_partition_id()).distinct().count() > 1
    assert values(ranges.batch_heights(spark.createDataFrame([(3, 5)], "batch_start bigint, batch_end bigint")), "height") == [(3,), (4,), (5,)]


@pytest.mark.parametrize("name", ["archive_key", "missing_ranges", "parse_archives", "coverage_gaps", "batch_stats"])
def test_batches_do_not_widen_with_the_table(spark, tmp_path_factory, name):
    folder = tmp_path_factory.getbasetemp() / "large"
    con = duckdb.connect()
    orders, lines = f"{folder}/orders.parquet", f"{folder}/lineitem.parquet"
    if not folder.exists():
        folder.mkdir()
        con.execute(
            f"copy (select range as o_orderkey, 1.5 * range + 7 as o_totalprice from range(1500000)) to '{orders}' (format parquet)"
        )
        con.execute(
            "copy (select range * 97 as l_orderkey, cast(1 as integer) as l_linenumber, 'R' as l_returnflag,"
            f" 30.5 as l_extendedprice from range(900)) to '{lines}' (format parquet)"
        )
    for table in ("orders", "lineitem"):
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    assert compare(con, entry_point.oracle_sql()[name], entry_point.queries()[name](spark, str(folder))) is None


def test_shared_folder_helpers(spark):
    path = scratch_path(spark, "gone")
    assert not exists(spark, path) and qualified(spark, "/tmp/x") == "file:///tmp/x"
    spark.range(2).write.parquet(path)
    assert exists(spark, path)
    discard(spark, path)
    assert not exists(spark, path)
    with pytest.raises(ValueError):
        discard(spark, "/elsewhere")


def test_fit_fallback_without_payload(spark):
    rows = spark.createDataFrame([(1, "block.json", 0), (1, "s", 1), (2, "block.json", 1), (3, "s", 1)], "height bigint, member string, size bigint")
    assert values(gaps.fit_fallback(rows), "height") == [(2,)]
    assert values(gaps.fit_fallback(rows, need_block=False), "height") == [(2,), (3,)]
