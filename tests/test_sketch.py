"""Few keys against a huge inventory: what a sketch lets through, and that nothing is lost."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import common, copying
from ledgerloom.session import scratch_path


@pytest.fixture
def inventory(spark):
    path = scratch_path(spark, "inventory")
    rows = spark.range(200_000).select(F.concat(F.lit("out/"), F.col("id").cast("string")).alias("key"), F.lit(1).cast("bigint").alias("size"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def keys_of(spark, numbers, name="key"):
    return spark.createDataFrame([(f"out/{n}",) for n in numbers], f"{name} string")


def test_all_matches_and_few_others_stay(spark, inventory):
    wanted = keys_of(spark, [*range(0, 400_000, 1000), 5, 5])
    kept = {r.key for r in common.possibly_among(inventory, wanted).collect()}
    assert {f"out/{n}" for n in [*range(0, 200_000, 1000), 5]} <= kept
    assert len(kept) < 200_000 / 10
    assert common.possibly_among(inventory, wanted.limit(0)).count() == 0
    odd = spark.createDataFrame([(None,), ("",)], "key string")
    assert [r.key for r in common.possibly_among(odd, odd).collect()] == [""]


def shuffled_rows(df):
    df._jdf.collectToPython()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_destination_rows_are_thinned_out_before_the_shuffle(spark, inventory, monkeypatch):
    wanted = keys_of(spark, range(0, 300_000, 3000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = copying.exists_keys(wanted, inventory)
        rows = shuffled_rows(few)
        answers = sorted(map(tuple, few.collect()))
        monkeypatch.setattr(common, "SKETCH_KEYS", 10)
        all_rows = copying.exists_keys(wanted, inventory)
        assert shuffled_rows(all_rows) > 200_000 and rows < 30_000
        assert answers == sorted(map(tuple, all_rows.collect()))
        assert answers.count(("out/3000", "FOUND")) == 1 and ("out/201000", "MISSING") in answers
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copy_plan_with_a_sketch(spark, inventory):
    source = spark.createDataFrame([(f"in/{n}", 1) for n in range(199_990, 200_010)], "key string, size bigint")
    plan = copying.copy_plan(source, inventory, "in/", "out/", copy_all_under_prefix=True)
    assert sorted(r.key for r in plan.collect()) == [f"in/{n}" for n in range(200_000, 200_010)]
