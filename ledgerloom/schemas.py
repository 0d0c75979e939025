"""Schemas of the data model."""

from pyspark.sql import types as T

INVENTORY = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("etag", T.StringType()),
    ]
)

# One stored object of a height. `priority` orders the sources, 1 is tried first.
OBJECTS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("height", T.LongType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)

ARCHIVES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("ext", T.StringType()),
    ]
)

MEMBERS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)

CONTROL = T.StructType([T.StructField("last_processed_number", T.LongType())])

# Statistics lines. Batches of a table are written together, so their time is that of the run;
# archives have seconds of their own.
BATCH_STATS = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("uncompressed_mb", T.LongType()),
        T.StructField("compressed_mb", T.LongType()),
        T.StructField("reduction_pct", T.DoubleType()),
        T.StructField("dirs", T.LongType()),
        T.StructField("run_sec", T.DoubleType()),
        T.StructField("download_sec", T.DoubleType()),
        T.StructField("compress_sec", T.DoubleType()),
        T.StructField("upload_sec", T.DoubleType()),
    ]
)

DOWNLOAD_STATS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("local_dir", T.StringType()),
        T.StructField("uncompressed_mb", T.LongType()),
        T.StructField("dirs_downloaded", T.LongType()),
        T.StructField("run_sec", T.DoubleType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("archive_key", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("batch_start", T.LongType()),
        T.StructField("batch_end", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("missing_shard_ids", T.ArrayType(T.StringType())),
        T.StructField("missing_range", T.StringType()),
        T.StructField("dest_dir", T.StringType()),
        T.StructField("fallback_url", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("start_from", T.LongType()),
        T.StructField("stop_at", T.LongType()),
        T.StructField("batch_dirs", T.LongType()),
        T.StructField("dry_run", T.BooleanType()),
    ]
)
