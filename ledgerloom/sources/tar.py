"""Members of existing ``.tar.gz`` and ``.tar.zst`` archives as rows."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import filesystem
from ..operators.common import broadcast_within
from ..schemas import MEMBERS
from ..session import ship_package

# Rows go back to Spark once this many payload bytes have gathered, so that memory in a
# task follows the largest member and not the archive.
_FLUSH_BYTES = 8 << 20
_FLUSH_ROWS = 4096


def open_archive(path: str):
    """Byte stream of an archive, decompressed on the fly, on any file system pyarrow knows."""
    fs, location = filesystem(path)
    raw = fs.open_input_stream(location, compression=None)
    if path.lower().endswith(".tar.zst"):
        import zstandard

        return io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True))
    return gzip.GzipFile(fileobj=raw)


def _archive_rows(path: str, payloads: bool) -> Iterator[tuple]:
    try:
        with open_archive(path) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
            for info in tar:
                name = info.name.removeprefix("./")
                if not name or not (info.isreg() or info.isdir()):
                    continue
                if ".." in name:
                    yield path, info.name, None, None, "invalid member name"
                    return
                if info.isreg():
                    data = tar.extractfile(info).read() if payloads else None
                    yield path, name.removeprefix("/"), info.size, data, None
    except Exception as exc:  # a broken archive is a reported row, the others go on
        yield path, None, None, None, f"extract: {exc}"


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _expand(batches: Iterator[pa.RecordBatch], schema: pa.Schema, payloads: bool) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for row in _archive_rows(path, payloads):
                rows.append(row)
                held += len(row[3] or b"")
                if held >= _FLUSH_BYTES or len(rows) >= _FLUSH_ROWS:
                    yield _record_batch(rows, schema)
                    rows, held = [], 0
    if rows:
        yield _record_batch(rows, schema)


def expand_archives(paths: DataFrame, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """Members of the archives listed in ``path``, as ``archive, member, size, payload, error``.

    Members stream through a task one after the other; an archive is one compressed stream
    and cannot be cut. A name with two dots or a broken stream ends that archive with a row
    whose ``error`` is set.
    """
    schema = pa.schema(
        [
            ("archive", pa.string()),
            ("member", pa.string()),
            ("size", pa.int64()),
            ("payload", pa.binary()),
            ("error", pa.string()),
        ]
    )
    ship_package(paths.sparkSession)
    # A fixed number of tasks: paths are tiny, so size-based coalescing would put all
    # archives into one task.
    tasks = tasks or 4 * paths.sparkSession.sparkContext.defaultParallelism
    spread = paths.select("path").repartition(tasks)
    return spread.mapInArrow(lambda it: _expand(it, schema, payloads), MEMBERS)


def archive_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the tar archives anywhere below `folder`."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[tT][aA][rR].*")
        .load(folder)
    )
    return files.select("path").where(F.lower("path").rlike(r"\.tar\.(gz|zst)\z"))


def readable_members(members: DataFrame) -> DataFrame:
    """Members of archives that could be read to the end.

    `members` should be a written table: it is scanned twice, the first time for its
    ``archive`` and ``error`` columns only.
    """
    failed = members.where("error is not null").select("archive").distinct()
    good = members.where("error is null").drop("error")
    return good.join(broadcast_within(failed), "archive", "left_anti")
