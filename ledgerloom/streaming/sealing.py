"""Batches that are sealed once the head is far enough ahead.

A height is a point on the event-time axis, one second per height. The first batch begins one
batch length after time 0, because a row at the initial watermark would count as late. Batches
are then tumbling windows, and the hot window is the watermark delay.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.checks import batch_end, batch_start
from ..operators.ranges import assign_batch
from ..session import exists, hadoop_path
from ..sinks.batches import balanced


def _timed(stream: DataFrame, start: int, size: int, hot: int) -> DataFrame:
    at = F.timestamp_seconds(F.col("height") - start + size)
    return stream.withColumn("hts", at).withWatermark("hts", f"{hot} seconds")


def _window_start(start: int, size: int) -> Column:
    return F.unix_timestamp("window.start") + (start - size)


def sealed_batches(stream: DataFrame, start: int, size: int, hot: int) -> DataFrame:
    """Batches and their number of landed rows, each emitted once when it is sealed (append mode)."""
    windows = _timed(stream, start, size, hot).groupBy(F.window("hts", f"{size} seconds"))
    first = _window_start(start, size)
    return windows.agg(F.count("*").alias("dirs")).select(
        first.alias("batch_start"), (first + size - 1).alias("batch_end"), "dirs"
    )


def sealed_now(landed: DataFrame, start: int, size: int, hot: int) -> DataFrame:
    """The same batches from a table: sealed iff ``batch_end + 1 + hot <= latest``."""
    first = batch_start("height", start, size)
    batches = landed.groupBy(first.alias("batch_start")).agg(F.count("*").alias("dirs"))
    head = landed.agg(F.max("height")).scalar()
    return batches.where(F.col("batch_start") + size + hot <= head).select(
        "batch_start", batch_end("batch_start", size).alias("batch_end"), "dirs"
    )


# Heights per word of the streamed presence.
WORD = 64


def stream_gap_counts(stream: DataFrame, start: int, size: int, hot: int) -> DataFrame:
    """Missing heights per sealed batch. Batches without any row never show up here.

    Presence is one bit per height, combined before the shuffle, so a height that comes again and
    again is one bit of one word; the state holds a row per 64 heights of the open batches.
    """
    first = _window_start(start, size)
    offset = F.col("height") - start
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(offset, F.lit(WORD)).cast("int"))
    words = (
        _timed(stream.select("height"), start, size, hot)
        .withColumn("_word", F.floor(offset / WORD))
        .withColumn("_bit", bit)
        .groupBy(F.window("hts", f"{size} seconds"), "_word")
        .agg(F.bit_or("_bit").alias("_bits"))
    )
    seen = words.groupBy("window").agg(F.sum(F.bit_count("_bits")).alias("seen"))
    return seen.select(
        first.alias("batch_start"),
        (first + size - 1).alias("batch_end"),
        F.col("seen"),
        (F.lit(size) - F.col("seen")).alias("missing"),
    )


def late_heights(landed: DataFrame, sealed: DataFrame, start: int, size: int) -> DataFrame:
    """Landed heights that belong to batches already sealed."""
    keyed = landed.select("height", batch_start("height", start, size).alias("batch_start"))
    return keyed.join(sealed.select("batch_start"), "batch_start", "left_semi").select("height")


def follow_head(query: DataStreamWriter, interval: str | None = None) -> StreamingQuery:
    """Start a query that keeps up with the head; without an interval it stops when caught up."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return query.trigger(**trigger).start()


def write_summary(sealed: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Sealed batches appended to a Parquet table, exactly once across restarts."""
    return (
        sealed.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def resume(sealed: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Continue from `checkpoint`, or begin there: sealed batches are not emitted again."""
    return follow_head(write_summary(sealed, path, checkpoint), interval)


def open_windows(spark: SparkSession, checkpoint: str, start: int, size: int) -> DataFrame:
    """Batches that :func:`sealed_batches` holds open in its state, with their rows so far.

    Read from the state store of the last committed micro-batch, before a stream is resumed.
    """
    state = spark.read.format("statestore").load(checkpoint)
    first = F.unix_timestamp("key.window.start") + (start - size)
    return state.select(
        first.alias("batch_start"), (first + size - 1).alias("batch_end"), F.col("value.count").alias("dirs")
    )


def stateful_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators with state below a checkpoint, and the micro-batches their state is kept for."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId"
    )


def head_at(spark: SparkSession, checkpoint: str, start: int, size: int, hot: int) -> int | None:
    """Highest height that the watermark of a checkpoint has seen; None before the first one."""
    entries = _numbered(spark, f"{checkpoint}/offsets")
    for number in sorted(entries, reverse=True):
        lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{number}", wholetext=True).collect()][0].split("\n")
        mark = json.loads(lines[1]).get("batchWatermarkMs", 0)
        return mark // 1000 + hot + start - size if mark else None
    return None


_STATE = "batch_start bigint, head bigint"
_CONTROL = "batch_start bigint, epoch bigint"
_LATE = "height bigint, batch_start bigint, epoch bigint"

# Folders read or written by one step of a micro-batch; more of them take several steps.
FOLDERS = 500

# Micro-batches between two snapshots of the control table.
COMPACTION = 10


def write_sealed(stream: DataFrame, path: str, checkpoint: str, start: int, size: int, hot: int) -> DataStreamWriter:
    """Land rows as they come and move whole batches to `path` once they are sealed.

    ``<path>/landing`` holds arrived rows by batch and micro-batch, ``<path>/batches`` the
    sealed batches, ``<path>/late`` each height that arrived after its batch was sealed, once,
    ``<path>/control`` one row per sealed batch as deltas, and now and then a snapshot. Each
    micro-batch leaves its head and the batches still open in ``<path>/state``; the next one
    reads only that and removes what is older. It lists the folders of the batches it seals and
    of those it has late rows of, so its cost does not grow with the age of the stream. A
    repeated micro-batch overwrites what it wrote before. Late rows are landed, too.
    """

    def step(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        landing = f"{path}/landing"
        landed = assign_batch(rows, start, size).withColumn("epoch", F.lit(epoch).cast("bigint"))
        _replace(balanced(landed), landing, "batch_start", "epoch")

        state = spark.read.schema(_STATE)
        before = state.parquet(f"{path}/state/{epoch - 1}") if epoch else spark.createDataFrame([], _STATE)
        arrived = landed.groupBy("batch_start").agg(F.max("height").alias("head"))
        _replace(before.unionByName(arrived), f"{path}/seen/{epoch}")
        seen = state.parquet(f"{path}/seen/{epoch}")
        old = before.agg(F.max("head")).first()[0]
        old = -1 if old is None else old
        head = seen.agg(F.max("head")).first()[0]

        # A batch is due when the head passes its end; what the old head had passed is done.
        ready_at = F.col("batch_start") + size + hot
        due = seen.where((ready_at <= F.lit(head)) & (ready_at > F.lit(old)))
        still_open = seen.where(ready_at > F.lit(head)).select("batch_start").distinct()
        mark = spark.range(1).select(F.lit(None).cast("bigint").alias("batch_start"))
        _replace(still_open.union(mark).withColumn("head", F.lit(head).cast("bigint")), f"{path}/state/{epoch}")
        for part in ("state", "seen"):
            _remove_before(spark, f"{path}/{part}", epoch - 1)

        names = [r.batch_start for r in due.select("batch_start").distinct().collect()]
        if names:
            delta = spark.createDataFrame([(n, epoch) for n in names], _CONTROL)
            _replace(delta, f"{path}/control/deltas/{epoch}")
        for some in _chunks(names):
            table = _folders(spark, landing, some).where(F.col("epoch") <= epoch).drop("epoch")
            ready = assign_batch(table.drop("batch_start", "batch_end"), start, size)
            ordered = balanced(ready).sortWithinPartitions("batch_start", "batch_end", "height")
            _replace(ordered, f"{path}/batches", "batch_start", "batch_end")

        late = landed.where(ready_at <= F.lit(old)).select("height", "batch_start", "epoch").distinct()
        tardy = [r.batch_start for r in seen.where(ready_at <= F.lit(old)).select("batch_start").distinct().collect()]
        for some in _chunks(tardy):
            new = late.where(F.col("batch_start").isin(some))
            known = [n for n in some if exists(spark, f"{path}/late/batch_start={n}")]
            if known:
                told = _folders(spark, f"{path}/late", known, _LATE).where(F.col("epoch") < epoch)
                new = new.join(told.select("height"), "height", "left_anti")
            _replace(new, f"{path}/late", "batch_start", "epoch")
        if epoch % COMPACTION == COMPACTION - 1:
            _compact(spark, f"{path}/control", epoch)

    spark = stream.sparkSession
    spark.createDataFrame([], assign_batch(stream, start, size).schema).write.mode("append").partitionBy(
        "batch_start", "batch_end"
    ).parquet(f"{path}/batches")
    spark.createDataFrame([], _LATE).write.mode("append").partitionBy("batch_start", "epoch").parquet(f"{path}/late")
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def _chunks(names: list[int]) -> Iterator[list[int]]:
    names = sorted(names)
    for k in range(0, len(names), FOLDERS):
        yield names[k : k + FOLDERS]


def _folders(spark: SparkSession, table: str, names: list[int], schema: str | None = None) -> DataFrame:
    """Rows of some batches of a table by batch, without a listing of the others."""
    reader = spark.read.option("basePath", table)
    return (reader.schema(schema) if schema else reader).parquet(*(f"{table}/batch_start={n}" for n in names))


def _replace(df: DataFrame, path: str, *folders: str) -> None:
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if folders:
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    else:
        writer.option("partitionOverwriteMode", "static").parquet(path)


def _numbered(spark: SparkSession, path: str) -> list[int]:
    """Numbers that name the children of a folder."""
    found, store = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(found)] if store.exists(found) else []
    return [int(n) for n in names if n.isdigit()]


def _remove_before(spark: SparkSession, path: str, number: int) -> None:
    """Remove the numbered children of a folder below `number`."""
    for old in _numbered(spark, path):
        if old < number:
            found, store = hadoop_path(spark, f"{path}/{old}")
            store.delete(found, True)


def _snapshots(spark: SparkSession, control: str) -> list[int]:
    """Whole snapshots of a control table, in order."""
    numbers = sorted(_numbered(spark, f"{control}/snapshots"))
    return [n for n in numbers if exists(spark, f"{control}/snapshots/{n}/_SUCCESS")]


def _control(spark: SparkSession, control: str, snapshot: int | None) -> DataFrame:
    """A snapshot and the deltas after it."""
    rows = spark.read.schema(_CONTROL)
    paths = [f"{control}/deltas/{n}" for n in _numbered(spark, f"{control}/deltas") if snapshot is None or n > snapshot]
    if snapshot is not None:
        paths.append(f"{control}/snapshots/{snapshot}")
    return rows.parquet(*paths) if paths else spark.createDataFrame([], _CONTROL)


def _compact(spark: SparkSession, control: str, epoch: int) -> None:
    """A snapshot of all deltas up to `epoch`; deltas and snapshots before the last one but one go.

    Those in between stay for readers that listed them.
    """
    earlier = [n for n in _snapshots(spark, control) if n < epoch]
    rows = _control(spark, control, earlier[-1] if earlier else None).where(F.col("epoch") <= epoch)
    _replace(rows.coalesce(1), f"{control}/snapshots/{epoch}")
    if earlier:
        _remove_before(spark, f"{control}/deltas", earlier[-1] + 1)
        _remove_before(spark, f"{control}/snapshots", earlier[-1])


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Sealed batches of :func:`write_sealed` and the micro-batch that sealed them."""
    snapshots = _snapshots(spark, f"{path}/control")
    return _control(spark, f"{path}/control", snapshots[-1] if snapshots else None)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Heights that :func:`write_sealed` saw after their batch was sealed, each once."""
    return spark.read.schema(_LATE).parquet(f"{path}/late").select("height", "batch_start")
