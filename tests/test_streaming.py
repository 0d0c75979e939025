"""Sealing while the head advances, with restarts and late rows."""

from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.streaming import sealing


def land(spark, folder, heights):
    spark.createDataFrame([(h,) for h in heights], "height bigint").coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema("height bigint").option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_batch_is_sealed_once_the_head_is_far_enough(spark):
    folder = scratch_path(spark, "s")

    def run():
        sealed = sealing.sealed_batches(stream(spark, f"{folder}/in"), 0, 1000, 100)
        sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
        schema = "batch_start bigint, batch_end bigint, dirs bigint"
        return rows(spark.read.schema(schema).parquet(f"{folder}/out"))

    land(spark, f"{folder}/in", range(0, 2101))
    assert run() == [(0, 999, 1000), (1000, 1999, 1000)]
    land(spark, f"{folder}/in", range(2101, 3100))  # 3099: the third batch stays open
    assert run() == [(0, 999, 1000), (1000, 1999, 1000)]
    land(spark, f"{folder}/in", [3100, *range(500, 520)])  # 3100 seals it; 500.. is late
    assert run() == [(0, 999, 1000), (1000, 1999, 1000), (2000, 2999, 1000)]
    landed = spark.read.parquet(f"{folder}/in")
    static = sealing.sealed_now(landed, 0, 1000, 100)
    assert rows(static.select("batch_start")) == [(0,), (1000,), (2000,)]
    late = spark.createDataFrame([(510,), (3050,)], "height bigint")
    assert rows(sealing.late_heights(late, static, 0, 1000)) == [(510,)]


def test_other_starts(spark):
    folder = scratch_path(spark, "s")
    land(spark, f"{folder}/in", range(1, 32))
    sealed = sealing.sealed_batches(stream(spark, f"{folder}/in"), 1, 10, 0)
    sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out")) == [(1, 10, 10), (11, 20, 10), (21, 30, 10)]


def test_gap_counts_ignore_repeats(spark):
    folder = scratch_path(spark, "s")
    land(spark, f"{folder}/in", [0, 0, 1, 5, 5, 9])
    land(spark, f"{folder}/in", [0, *range(10, 18), 25])
    counts = sealing.stream_gap_counts(stream(spark, f"{folder}/in"), 0, 10, 5)
    sealing.resume(counts, f"{folder}/out", f"{folder}/ck").awaitTermination()
    got = spark.read.parquet(f"{folder}/out").select("batch_start", "seen", "missing")
    assert rows(got) == [(0, 4, 6), (10, 8, 2)]


def test_sealed_rows_are_moved_once(spark):
    folder = scratch_path(spark, "s")

    def run():
        writer = sealing.write_sealed(stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/ck", 0, 10, 5)
        sealing.follow_head(writer).awaitTermination()
        table = spark.read.schema("height bigint, batch_start bigint, batch_end bigint").parquet(f"{folder}/out/batches")
        return rows(table.groupBy("batch_start").count())

    land(spark, f"{folder}/in", range(0, 8))
    assert run() == []
    land(spark, f"{folder}/in", range(8, 26))
    assert run() == [(0, 10), (10, 10)]
    land(spark, f"{folder}/in", [3, 4, *range(26, 36)])  # 3 and 4 come late
    assert run() == [(0, 10), (10, 10), (20, 10)]
    assert sealing.read_control(spark, f"{folder}/out").count() == 3
    landing = spark.read.parquet(f"{folder}/out/landing")
    assert landing.where(F.col("height").isin(3, 4)).count() == 4


def test_each_late_height_is_told_once(spark):
    folder = scratch_path(spark, "s")

    def run():
        writer = sealing.write_sealed(stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/ck", 0, 10, 5)
        sealing.follow_head(writer).awaitTermination()
        return rows(sealing.read_late(spark, f"{folder}/out"))

    land(spark, f"{folder}/in", range(0, 30))
    assert run() == []
    land(spark, f"{folder}/in", [3, 3, 14, 24])
    assert run() == [(3, 0), (14, 10)]  # 24's batch is still open
    land(spark, f"{folder}/in", [3, 4, *range(30, 40)])
    land(spark, f"{folder}/in", [24, 4])
    assert run() == [(3, 0), (4, 0), (14, 10), (24, 20)]


def test_a_micro_batch_costs_the_same_at_any_age(spark, monkeypatch):
    monkeypatch.setattr(sealing, "COMPACTION", 2)
    monkeypatch.setattr(sealing, "FOLDERS", 2)
    folder = scratch_path(spark, "s")
    counts = []
    for k in range(11):
        land(spark, f"{folder}/in", range(30 * k, 30 * k + 30))  # three batches at a time
        writer = sealing.write_sealed(stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/ck", 0, 10, 5)
        sealing.follow_head(writer).awaitTermination()
        kept = {part: sealing._numbered(spark, f"{folder}/out/{part}") for part in ("state", "seen", "control/deltas", "control/snapshots")}
        counts.append({part: len(numbers) for part, numbers in kept.items()})
    assert counts[10] == counts[6] and counts[9] == counts[5]
    assert counts[10] == {"state": 2, "seen": 2, "control/deltas": 3, "control/snapshots": 2}
    control = sealing.read_control(spark, f"{folder}/out")
    assert rows(control.select("batch_start")) == [(b,) for b in range(0, 320, 10)]
    table = spark.read.parquet(f"{folder}/out/batches")
    assert table.count() == 320 and table.select("height").distinct().count() == 320


def test_state_can_be_looked_at_before_a_resume(spark):
    folder = scratch_path(spark, "s")
    land(spark, f"{folder}/in", range(0, 2350))
    sealed = sealing.sealed_batches(stream(spark, f"{folder}/in"), 0, 1000, 100)
    assert sealing.head_at(spark, f"{folder}/ck", 0, 1000, 100) is None
    sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    assert rows(sealing.open_windows(spark, f"{folder}/ck", 0, 1000)) == [(2000, 2999, 350)]
    assert sealing.head_at(spark, f"{folder}/ck", 0, 1000, 100) == 2349
    operators = sealing.stateful_operators(spark, f"{folder}/ck").collect()
    assert [r.operatorName for r in operators] == ["stateSaveAggregate"] or len(operators) == 1
    land(spark, f"{folder}/in", range(2350, 2600))
    sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    assert rows(sealing.open_windows(spark, f"{folder}/ck", 0, 1000)) == [(2000, 2999, 600)]


def test_a_live_query_follows_a_head_that_moves(spark):
    folder = scratch_path(spark, "s")
    land(spark, f"{folder}/in", range(0, 12))
    out = spark.read.schema("batch_start bigint, batch_end bigint, dirs bigint")

    def live():
        sealed = sealing.sealed_batches(stream(spark, f"{folder}/in"), 0, 10, 5)
        return sealing.resume(sealed, f"{folder}/out", f"{folder}/ck", "1 second")

    query = live()
    try:
        query.processAllAvailable()
        land(spark, f"{folder}/in", range(12, 26))
        query.processAllAvailable()
        assert rows(out.parquet(f"{folder}/out")) == [(0, 9, 10), (10, 19, 10)]
        land(spark, f"{folder}/in", range(26, 36))
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(out.parquet(f"{folder}/out")) == [(0, 9, 10), (10, 19, 10), (20, 29, 10)]
    land(spark, f"{folder}/in", range(36, 46))
    query = live()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(out.parquet(f"{folder}/out")) == [(0, 9, 10), (10, 19, 10), (20, 29, 10), (30, 39, 10)]
