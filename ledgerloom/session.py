"""Session settings and the folder that executors share."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# SQL settings the operators rely on. All of them can be set on a running session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Equi-joins on a hot height split that height over several tasks, also when the
    # join is followed by an aggregate on the same key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compaction uses REBALANCE; a hot batch is cut into several files.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SQL_CONF`` to a running session and make this package importable on executors."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


# Bytes of an Arrow batch of texts. Spark's own limits, 64 MB and 10,000 rows, cost each task some
# hundred MB outside the heap: the batch, its larger buffers and Python's copy.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in small batches, unless the session has a limit of its own."""
    if BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def local_session(cores: int | str = 8, app: str = "ledgerloom", shared: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark, with `shared` as its shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        # Local data is tiny; without this, AQE would put all of it into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    On a cluster a folder of the machine's own file system, which may be a mounted store, is tried
    out first. Only a local session may go without a folder; it then gets a temporary one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if not configured and local:
        return _local_folder(spark.sparkContext.applicationId)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = configured.rstrip("/")
    if not local and qualified(spark, folder).startswith("file:"):
        _require_shared(spark, folder)
    return folder


_tried: set[tuple[str, str]] = set()


def _require_shared(spark: SparkSession, folder: str) -> None:
    """Raise unless the driver sees what the tasks of a small job write; once per application."""
    known = (spark.sparkContext.applicationId, folder)
    if known in _tried:
        return
    path, tasks = f"{folder}/shared-{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    found, store = hadoop_path(spark, path)
    seen = sum(file.getPath().getName().startswith("part-") for file in store.listStatus(found))
    store.delete(found, True)
    if seen < tasks:
        raise ValueError(f"executors don't share {folder}: set spark.checkpoint.dir to a folder that they do")
    _tried.add(known)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerloom-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """Path and file system of a location in any store that Spark reads."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, store = hadoop_path(spark, path)
    return store.exists(found)


def qualified(spark: SparkSession, folder: str) -> str:
    """`folder` with the scheme and store Spark resolves it to, so that tasks open the same one."""
    found, store = hadoop_path(spark, folder.rstrip("/"))
    full = store.makeQualified(found).toString()
    return full if full.startswith("file://") or not full.startswith("file:") else "file://" + full.removeprefix("file:")


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    if not path.startswith(shared_dir(spark)):
        raise ValueError(f"{path} is not below the shared folder")
    found, store = hadoop_path(spark, path)
    store.delete(found, True)


def materialise(df: DataFrame, name: str, into: list[str] | None = None) -> DataFrame:
    """Write `df` to the shared folder once and read it back, where several steps need it.

    The path is added to `into`, for a caller that discards it when nothing reads it any more.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if into is not None:
        into.append(path)
    return df.sparkSession.read.parquet(path)
