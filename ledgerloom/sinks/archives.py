"""Range batches as ``.tar.zst`` or ``.tar.gz`` archives."""

from __future__ import annotations

import tarfile
import time
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import filesystem
from ..session import qualified
from ..functions.keys import archive_key, height_key
from ..operators.ranges import assign_batch
from ..session import ship_package
from .batches import balanced

# Rows of an archive's members, and a last one with the archive's own size and times.
MEMBERS = (
    "path string, batch_start bigint, batch_end bigint, member string, size bigint, at bigint, span bigint, skip bigint, "
    "stored bigint, download_sec double, compress_sec double, upload_sec double"
)
_MEMBER_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("batch_start", pa.int64()),
        ("batch_end", pa.int64()),
        ("member", pa.string()),
        ("size", pa.int64()),
        ("at", pa.int64()),
        ("span", pa.int64()),
        ("skip", pa.int64()),
        ("stored", pa.int64()),
        ("download_sec", pa.float64()),
        ("compress_sec", pa.float64()),
        ("upload_sec", pa.float64()),
    ]
)

# Unpacked bytes after which a frame ends, at the next member.
FRAME_BYTES = 1 << 20

_TAR_BLOCK, _TAR_END = 512, 1024


class _Archive:
    """One tar stream being written, as frames that unpack on their own."""

    def __init__(self, path: str, codec: str, level: int):
        fs, location = filesystem(path)
        fs.create_dir(location.rpartition("/")[0], recursive=True)
        self.raw = fs.open_output_stream(location, compression=None)
        self._codec, self._level = codec, level
        self._packer = None
        self._frame = self._at = 0  # unpacked bytes of the open frame, stored bytes before it
        self._stored = 0
        self._open: list[tuple] = []
        self.waited = self.compressing = self.uploading = 0.0

    def _write(self, data: bytes) -> None:
        if self._packer is None:
            if self._codec == "zstd":
                import zstandard

                self._packer = zstandard.ZstdCompressor(level=self._level).compressobj()
            else:
                self._packer = zlib.compressobj(self._level, wbits=31)
        self._frame += len(data)
        self._put(self._packer.compress, data)

    def _put(self, pack, *data: bytes) -> None:
        began = time.monotonic()
        packed = pack(*data)
        self.compressing += time.monotonic() - began
        began = time.monotonic()
        self.raw.write(packed)
        self.uploading += time.monotonic() - began
        self._stored += len(packed)

    def add(self, name: str, payload: bytes) -> None:
        info = tarfile.TarInfo(name)
        info.size = len(payload)
        self._write(info.tobuf(tarfile.PAX_FORMAT, "utf-8", "surrogateescape"))
        self._open.append((name, len(payload), self._frame))
        self._write(payload + bytes(-len(payload) % _TAR_BLOCK))

    def cut(self) -> list[tuple]:
        """End the frame; the members in it, as ``member, size, at, span, skip``."""
        if self._packer is None:
            return []
        self._put(self._packer.flush)
        span = self._stored - self._at
        ended = [(name, size, self._at, span, skip, *[None] * 4) for name, size, skip in self._open]
        self._packer, self._open, self._frame, self._at = None, [], 0, self._stored
        return ended

    def full(self) -> bool:
        return self._frame >= FRAME_BYTES

    def close(self) -> list[tuple]:
        ended = self.cut()
        self._write(bytes(_TAR_END))
        self.cut()
        began = time.monotonic()
        self.raw.close()
        self.uploading += time.monotonic() - began
        return [*ended, (*[None] * 5, self._stored, self.waited, self.compressing, self.uploading)]


def _pack(batches: Iterator[pa.RecordBatch], folder: str, codec: str, level: int) -> Iterator[pa.RecordBatch]:
    # An attempt writes below a folder of its own, so a repeated task never meets half-written
    # files; only archives named in the index count.
    context = TaskContext.get()
    root = f"{folder}/task-{context.partitionId():05d}-{context.taskAttemptId()}"
    archive = key = is_block = None

    def rows(ended: list[tuple]) -> pa.RecordBatch:
        named = [(f"{root}/{key[0]}", key[1], key[2], *row) for row in ended]
        columns = list(zip(*named)) or [[]] * len(_MEMBER_SCHEMA)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MEMBER_SCHEMA)], schema=_MEMBER_SCHEMA)

    began, waited = time.monotonic(), 0.0
    for batch in batches:
        # What a task waits for is the rows of the archive it writes, or of the next one.
        waited += time.monotonic() - began
        columns = (batch.column(c).to_pylist() for c in ("key", "batch_start", "batch_end", "name", "block", "payload"))
        for *row_key, name, block, payload in zip(*columns):
            if row_key != key:
                if archive is not None:
                    yield rows(archive.close())
                key, archive = row_key, _Archive(f"{root}/{row_key[0]}", codec, level)
            elif archive.full() or block != is_block:
                # Blocks have frames of their own: who wants headers unpacks no shards.
                yield rows(archive.cut())
            is_block = block
            archive.waited, waited = archive.waited + waited, 0.0
            archive.add(name, payload or b"")
        began = time.monotonic()
    if archive is not None:
        yield rows(archive.close())


def pack_archives(
    df: DataFrame, folder: str, start: int, size: int, codec: str = "zstd", level: int = 6, prefix: str = "archives"
) -> DataFrame:
    """Write ``height, member, payload`` rows to tar archives named by batch range.

    Rows stream into the archive in height order, blocks before all other members, as frames of
    about a megabyte that unpack on their own. A batch too big for one task is cut into archives of
    the same range name below different task folders. Stored next to the archives are the index
    of their members (:func:`archive_index`) and the manifest, which is returned: a row per archive
    with its members, bytes and seconds of waiting for rows, compressing and writing.
    """
    rows = assign_batch(df, start, size).select(
        archive_key("batch_start", "batch_end", prefix, codec).alias("key"),
        *("batch_start", "batch_end", "height", "member"),
        F.concat(height_key("height"), F.col("member")).alias("name"),
        (F.col("member") == "block.json").alias("block"),
        F.col("payload").cast("binary").alias("payload"),
    )
    ordered = balanced(rows).sortWithinPartitions("batch_start", "batch_end", F.desc("block"), "height", "member")
    ship_package(df.sparkSession)
    root = qualified(df.sparkSession, folder)
    packed = ordered.mapInArrow(lambda it: _pack(it, root, codec, level), MEMBERS)
    packed.write.mode("error").parquet(f"{folder}/_index")
    spark = df.sparkSession
    members = spark.read.schema(MEMBERS).parquet(f"{folder}/_index")
    manifest = members.groupBy("path", "batch_start", "batch_end").agg(
        F.count("member").alias("members"),
        F.count_distinct(F.substring_index("member", "/", 1)).alias("dirs"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        *(F.sum(c).alias(c) for c in ("stored", "download_sec", "compress_sec", "upload_sec")),
    )
    manifest.write.mode("error").parquet(f"{folder}/_manifest")
    return spark.read.parquet(f"{folder}/_manifest")


def archive_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index of the members that :func:`pack_archives` wrote below `folder`, for reading in parts."""
    rows = spark.read.schema(MEMBERS).parquet(f"{folder}/_index").where("member is not null")
    return rows.select(
        F.col("path").alias("archive"), "member", "size", "at", "span", "skip", F.lit(None).cast("string").alias("error")
    )
