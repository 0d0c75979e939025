"""Copies of whole objects, checked on the way."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import filesystem
from ..session import qualified
from ..functions.keys import etag_md5
from ..session import ship_package

_CHUNK = 8 << 20


def _copy(source: str, target: str) -> tuple[int, str, int]:
    """Bytes read, their MD5, and the size of the written object."""
    from_fs, from_path = filesystem(source)
    to_fs, to_path = filesystem(target)
    to_fs.create_dir(to_path.rpartition("/")[0], recursive=True)
    read, digest = 0, hashlib.md5()
    with from_fs.open_input_stream(from_path, compression=None) as src:
        with to_fs.open_output_stream(to_path, compression=None) as out:
            while chunk := src.read(_CHUNK):
                out.write(chunk)
                digest.update(chunk)
                read += len(chunk)
    return read, digest.hexdigest(), to_fs.get_file_info(to_path).size


def _copy_rows(batches: Iterator[pa.RecordBatch], source: str, target: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            try:
                result = (*_copy(f"{source}/{row['key']}", f"{target}/{row['dest_key']}"), None)
            except Exception as exc:  # a failed object is a reported row, the others go on
                result = (None, None, None, str(exc))
            values = (row["key"], row["dest_key"], row["size"], row["want_md5"], *result)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def copy_objects(plan: DataFrame, source_root: str, dest_root: str, tasks: int | None = None) -> DataFrame:
    """Copy the planned objects and return a verdict each.

    `plan` holds ``key, dest_key, size, etag``. An object streams through one task in chunks.
    Verdicts, first failure first: ``error``, ``size_mismatch`` (bytes read), ``md5_mismatch``
    (against a single-part ETag), ``dest_size_mismatch``, ``ok``. Copying again overwrites.
    """
    spark = plan.sparkSession
    ship_package(spark)
    target = qualified(spark, dest_root)
    schema = pa.schema(
        [
            ("key", pa.string()),
            ("dest_key", pa.string()),
            ("size", pa.int64()),
            ("want_md5", pa.string()),
            ("read", pa.int64()),
            ("md5", pa.string()),
            ("written", pa.int64()),
            ("error", pa.string()),
        ]
    )
    # A fixed number of tasks: rows are tiny, so size-based coalescing would leave one task.
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    rows = plan.select("key", "dest_key", "size", etag_md5("etag").alias("want_md5")).repartition(tasks)
    columns = "key string, dest_key string, size bigint, want_md5 string, read bigint, md5 string, written bigint, error string"
    done = rows.mapInArrow(lambda it: _copy_rows(it, source_root.rstrip("/"), target, schema), columns)
    verdict = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.col("read") != F.col("size"), "size_mismatch")
        .when(F.col("md5") != F.col("want_md5"), "md5_mismatch")
        .when(F.col("written") != F.col("size"), "dest_size_mismatch")
        .otherwise("ok")
    )
    return done.select("key", "dest_key", "size", "md5", verdict.alias("verdict"), "error")
