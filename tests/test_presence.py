"""Presence bitmaps against sets, and what they shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import gaps, presence
from ledgerloom.sources.inventory import height_domain


def heights(spark, values):
    return spark.createDataFrame([(h,) for h in values], "height bigint")


@pytest.mark.parametrize(
    "low, high, share",
    [(0, 70_000, 0.9), (7, 7, 1), (7, 7, 0), (5, 32_772, 0.5), (5, 32_773, 0.99), (100, 99, 0.5), (0, 32_767, 1), (0, 32_768, 1)],
)
def test_absent_heights(spark, low, high, share):
    random.seed(low + high)
    have = [h for h in range(low - 50, high + 50) if random.random() < share]
    rows = heights(spark, have + have[:10] + [None] if have else have)
    got = [r.height for r in presence.absent_heights(spark, rows, low, high).collect()]
    assert sorted(got) == sorted(set(range(low, high + 1)) - set(have))


def test_absent_in_overlapping_batches(spark):
    random.seed(3)
    batches = [(0, 9), (10, 40_000), (50_000, 50_000), (3, 20), (9, 5)]
    rows = [(a, b, h) for a, b in batches[:4] for h in range(a - 3, b + 4) if random.random() < 0.8]
    kept = spark.createDataFrame([(a, b, f"p{a}") for a, b in batches], "batch_start bigint, batch_end bigint, parent string")
    held = spark.createDataFrame(rows, "batch_start bigint, batch_end bigint, height bigint")
    got = presence.absent_in_batches(kept, held, ("parent",))
    assert got.columns == ["batch_start", "batch_end", "parent", "height"]
    want = sorted((a, b, f"p{a}", h) for a, b in batches for h in range(a, b + 1) if (a, b, h) not in set(rows))
    assert sorted(map(tuple, got.collect())) == want


def test_bitmaps_of_parts_are_put_together(spark):
    height = F.col("height")
    one, two = (presence.bitmaps(heights(spark, v), (), height) for v in ([1, 40_000], [1, 2]))
    both = presence.merged(one.unionByName(two), ())
    whole = presence.bitmaps(heights(spark, [1, 2, 40_000]), (), height)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))


def shuffled_bytes(spark, df):
    """Bytes written by the exchanges of a plan that has run."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    rows = df._jdf.collectToPython()  # runs the plan whose metrics are read
    del rows
    todo, total = [execution.executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_bitmaps_shuffle_a_tenth_at_most(spark):
    path = "/root/testdata/sf0.1/orders.parquet"
    have = spark.read.parquet(path).selectExpr("o_orderkey as height", "'block.json' as member", "1L as size").where("height % 997 != 5")
    bits, rows = gaps.missing_in_range(have, 0, 149_999), gaps.missing_heights(height_domain(spark, 0, 149_999), have)
    assert sorted(map(tuple, bits.collect())) == sorted(map(tuple, rows.collect()))
    plan = bits._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "NestedLoop" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = (shuffled_bytes(spark, df.select("*")) for df in (bits, rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < few * 10 <= many, (few, many)


def test_only_touched_heights_are_looked_at_again(spark):
    schema = "height bigint, member string, size bigint"
    have = [(0, "block.json", 1), (1, "block.json", 0), (2, "block.json", 1), (2, "shard_0.json", 0), (4, "block.json", 1)]
    fetched = [(1, "block.json", 2), (2, "shard_0.json", 3), (3, "block.json", 0), (4, "block.json", 0)]
    expected = spark.createDataFrame([(2, 0), (2, 1), (4, 0)], "height bigint, shard_id bigint")
    primary, fallback = spark.createDataFrame(have, schema), spark.createDataFrame(fetched, schema)
    wanted = gaps.refetch_set(gaps.missing_in_range(primary, 0, 4), gaps.missing_shards(expected, primary))
    lost_h, lost_s = gaps.still_missing(primary, fallback, wanted, expected)
    after = gaps.fill_gaps(primary, fallback, wanted)
    assert sorted(r.height for r in lost_h.collect()) == [3, 4]  # an empty fetched block took the place of 4's
    assert sorted(map(tuple, lost_h.collect())) == sorted(map(tuple, gaps.missing_in_range(after, 0, 4).collect()))
    assert sorted(map(tuple, lost_s.collect())) == sorted(map(tuple, gaps.missing_shards(expected, after).collect())) == [(2, 1)]


def test_short_batches_make_no_bitmap_per_task(spark):
    batches = spark.range(50).select((F.col("id") * 10).alias("batch_start"), (F.col("id") * 10 + 9).alias("batch_end"))
    rows = spark.range(500).where("id % 7 <> 3").repartition(6).select(
        (F.col("id") - F.col("id") % 10).alias("batch_start"),
        (F.col("id") - F.col("id") % 10 + 9).alias("batch_end"),
        F.col("id").alias("height"),
    )
    absent = presence.absent_in_batches(batches, rows.unionByName(rows))
    assert sorted(r.height for r in absent.collect()) == list(range(3, 500, 7))
    plan = absent._jdf.queryExecution().sparkPlan().toString() + absent._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    ends = [i for i, line in enumerate(lines) if "bitmap_construct_agg" in line and "Aggregate" in line]
    between = lines[ends[-2] : ends[-1]]
    assert "partial_bitmap_construct_agg" in lines[ends[-1]] and not any("Exchange" in line for line in between)
