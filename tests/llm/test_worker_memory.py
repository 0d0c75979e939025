"""What executors need for Python: workers at once, kinds of workers, tables beside one another."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard_join, weak_labels
from ledgerloom.session import BATCH_KEY, small_batches


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def documents(spark):
    texts = ["one two three four", "one two three four", "five six seven", "", None, "nine ten eleven twelve"]
    return spark.createDataFrame([(k, t) for k, t in enumerate([*texts, "of no id"])], "doc_id bigint, text string").select(
        F.when(F.col("doc_id") < len(texts), F.col("doc_id")).alias("doc_id"), "text"
    )


def test_no_task_runs_two_python_functions(spark):
    docs = documents(spark)
    texts = weak_labels._texts(docs, docs.select("doc_id").distinct())
    assert plan(weak_labels._voted(texts, weak_labels.Lists(), True)).count("MapInArrow") == 1
    # One of each group of equal texts, those without words among them.
    assert {r.doc_id: r.text for r in texts.collect()} == {
        0: "one two three four", 2: "five six seven", 3: "", 5: "nine ten eleven twelve"
    }


def test_wanted_patterns_start_no_python_workers(spark):
    votes = spark.range(40).select(
        F.when(F.col("id") < 39, F.col("id")).alias("doc_id"), (F.col("id") % 2).cast("int").alias("low"), F.lit(3).alias("toxic")
    )
    counted = [Row(low=0, toxic=3, count=20), Row(low=1, toxic=3, count=20)]
    chosen = weak_labels._of_patterns(votes, counted, 5)
    assert "RDD" not in plan(chosen)
    ids = [r.doc_id for r in chosen.collect()]
    assert len(set(ids)) == 10 and sum(k % 2 for k in ids) == 5
    assert weak_labels._of_patterns(votes.where("false"), [], 5).collect() == []


def test_buckets_are_counted_without_a_second_table():
    rng = np.random.default_rng(3)
    counts = np.zeros(1 << jaccard_join.BUCKET_BITS, np.uint32)
    held = [rng.integers(0, len(counts), 50_000) for _ in range(4)]
    held[0][:1000] = 7
    want = 2 * np.bincount(np.concatenate(held), minlength=len(counts))
    tracemalloc.start()
    for _ in range(2):
        jaccard_join._count(counts, held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (counts == want).all() and peak < counts.nbytes


def test_texts_go_to_python_in_small_batches(spark):
    session = spark.newSession()
    default = int(session.conf.get(BATCH_KEY).removesuffix("b"))
    docs = session.range(24).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200_000).alias("text")).coalesce(1)

    def run(batches):
        for k, batch in enumerate(batches):
            yield pa.RecordBatch.from_arrays([pa.array([k] * batch.num_rows, pa.int64())], ["batch"])

    def most():
        return docs.mapInArrow(run, "batch bigint").groupBy("batch").count().agg(F.max("count")).first()[0]

    small_batches(session)
    assert most() <= 6 and default > 1 << 24
    own = spark.newSession()
    own.conf.set(BATCH_KEY, "16m")
    small_batches(own)
    assert own.conf.get(BATCH_KEY) == "16m"
