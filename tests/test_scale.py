"""Plans and layouts that must hold when one key has a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import common, copying, gaps, ranges, stats
from ledgerloom.session import scratch_path, shared_dir
from ledgerloom.sinks import batches as sink
from ledgerloom.sources.inventory import scan_inventory


@pytest.fixture
def conf(spark):
    changed = {}

    def set_(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_objects(spark, n=60000):
    """A third of the rows belong to height 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("height"),
        (F.col("id") % 2 + 1).cast("int").alias("priority"),
        F.concat(F.lit("shard_"), F.col("id").cast("string"), F.lit(".json")).alias("member"),
        F.lit(3).cast("bigint").alias("size"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


def test_hot_height_is_split_in_the_source_choice(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    objects = spark.read.parquet(write(spark, hot_objects(spark).repartition(8)))
    chosen = gaps.first_source(objects)
    plan = final_plan(chosen)
    assert "SortMergeJoin(skew=true)" in plan
    assert chosen.count() == objects.where("height <> 0 or priority = 1").count()


def write(spark, df):
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    return path


def test_hot_batch_becomes_several_files(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "600k")
    path = scratch_path(spark, "hot")
    rows = hot_objects(spark).repartition(40)
    totals = sink.write_batches(rows, path, 0, 10000)
    stored = sink.read_batches(spark, path)
    assert sink.verify_totals(stored, totals) and totals["files"] == 60000
    files = stored.select("batch_start", F.input_file_name().alias("file")).distinct()
    counts = {r.batch_start: r["count"] for r in files.groupBy("batch_start").count().collect()}
    assert counts[0] > max(n for b, n in counts.items() if b)
    assert not sink.verify_totals(stored.where("height <> 3001"), totals)


def test_losing_listings_are_broadcast_only_when_few(spark, monkeypatch):
    objects = spark.read.parquet(write(spark, hot_objects(spark, 3000)))
    few = gaps.first_source(objects, check_overlap=True)
    assert "BroadcastHashJoin" in final_plan(few)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(gaps, "broadcast_within", lambda df: common.broadcast_within(df, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    many = gaps.first_source(objects, check_overlap=True)
    assert "Broadcast" not in final_plan(many)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_batch_assignment_is_an_equi_join(spark):
    heights = spark.range(1000).select(F.col("id").alias("height"))
    batches = spark.range(0, 1000, 100).select(F.col("id").alias("batch_start"))
    plan = final_plan(ranges.assign_batch(heights, 0, 100).join(batches, "batch_start"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "pushed")
    sink.write_batches(hot_objects(spark, 3000), path, 0, 1000)
    rows = sink.read_batches(spark, path)
    plan = stats.dir_size(rows.where("height > 2500 and size > 0"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(height,2500)" in plan and "GreaterThan(size,0)" in plan
    assert "payload" not in plan
    one = rows.where("batch_start = 1000")
    assert len(one.inputFiles()) and "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString()


def test_prefix_reaches_the_inventory_scan(spark):
    path = write(spark, spark.createDataFrame([("data/a", 1, "e"), ("x", 2, "f")], "key string, size bigint, etag string"))
    plan = scan_inventory(spark, path, "data/")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(key,data/)" in plan and "etag" not in plan


def test_only_folders_of_wanted_batches_are_read(spark):
    path = scratch_path(spark, "pruned")
    sink.write_batches(hot_objects(spark, 3000), path, 0, 1000)
    keys = spark.read.parquet(write(spark, spark.createDataFrame([(1000, 1999)], "batch_start bigint, batch_end bigint")))
    rows = common.of_batches(sink.read_batches(spark, path), keys)
    plan = final_plan(rows)
    assert "dynamicpruning" in plan
    assert {r.batch_start for r in rows.collect()} == {1000}


def test_folders_between_the_first_and_last_batch_are_read_at_most(spark, monkeypatch):
    path = scratch_path(spark, "pruned")
    sink.write_batches(hot_objects(spark, 5000), path, 0, 1000)
    keys = spark.read.parquet(write(spark, spark.createDataFrame([(1000, 1999), (2000, 2999)], "batch_start bigint, batch_end bigint")))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    rows = common.of_batches(sink.read_batches(spark, path), keys)
    assert "PartitionFilters: [isnotnull(batch_start" in rows._jdf.queryExecution().executedPlan().toString()
    assert {r.batch_start for r in rows.collect()} == {1000, 2000}
    assert common.of_batches(sink.read_batches(spark, path), keys.limit(0)).count() == 0


def test_totals_are_combined_before_the_shuffle(spark):
    plan = stats.batch_stats(hot_objects(spark, 3000), 0, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")  # printed top down: partial below its exchange


def test_only_slice_totals_meet_in_one_task(spark):
    df = spark.range(5000).select(F.concat(F.lit("a/"), F.col("id").cast("string")).alias("key"))
    plan = copying.delete_manifest(df, "a/")._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(plan) if "SinglePartition" in line]
    assert single and all("HashAggregate(keys=[_slice" in plan[i + 1] for i in single)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
