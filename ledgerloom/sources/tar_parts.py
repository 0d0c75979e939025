"""Archives read in parts, by an index of their members.

A ``.tar.zst`` or ``.tar.gz`` archive may consist of several frames, each of which unpacks on its
own. The index has a row per member: where its frames begin, how many bytes they take and where
in them the payload lies. With it, listings and audits read no archive at all, chosen members
take the frames they lie in, and one large archive is the work of many tasks. ``pack_archives``
keeps an index of what it writes; :func:`index_archives` makes one of existing archives in one
pass. An archive of a single frame has an index, too, but its members all need that frame.
"""

from __future__ import annotations

import io
import tarfile
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..files import filesystem
from ..functions.checks import whole_div
from ..session import ship_package

INDEX = "archive string, member string, size bigint, at bigint, span bigint, skip bigint, error string"
INDEX_SCHEMA = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("size", pa.int64()),
        ("at", pa.int64()),
        ("span", pa.int64()),
        ("skip", pa.int64()),
        ("error", pa.string()),
    ]
)
MEMBERS = "archive string, member string, size bigint, payload binary"

# Stored bytes of an archive that one group of rows reads.
PART_BYTES = 32 << 20

# Bytes read from a store at once, and rows or payload bytes that go back to Spark at once.
CHUNK, FLUSH_BYTES, FLUSH_ROWS = 1 << 20, 8 << 20, 4096


def _unpacker(path: str):
    """Decompressor of one frame."""
    if path.lower().endswith(".tar.zst"):
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj(wbits=31)


class _Frames(io.RawIOBase):
    """Unpacked bytes of an archive; notes where each frame begins, stored and unpacked."""

    def __init__(self, path: str):
        fs, location = filesystem(path)
        self._path, self._raw = path, fs.open_input_stream(location, compression=None)
        self.starts, self.offsets = [0], [0]
        self._unpacker, self._held, self._taken, self._given = _unpacker(path), b"", 0, 0
        self._ready = b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self._ready:
            if not self._held:
                self._held = self._raw.read(CHUNK)
                self._taken += len(self._held)
                if not self._held:
                    if not self.done():
                        raise EOFError("the archive ends within a frame")
                    return 0
            if self._unpacker.eof:
                self._unpacker = _unpacker(self._path)
                self.starts.append(self._taken - len(self._held))
                self.offsets.append(self._given)
            self._ready = self._unpacker.decompress(self._held)
            self._held = self._unpacker.unused_data if self._unpacker.eof else b""
            self._given += len(self._ready)
        part, self._ready = self._ready[: len(target)], self._ready[len(target) :]
        target[: len(part)] = part
        return len(part)

    def done(self) -> bool:
        return self._unpacker.eof or self._taken == 0

    def stored(self) -> int:
        """Bytes read so far."""
        return self._taken - len(self._held)


def _indexed(path: str) -> Iterator[tuple]:
    """Index rows of one archive; a last row has the error of a broken one."""
    found, error = [], None
    frames = None
    try:
        frames = _Frames(path)
        with tarfile.open(fileobj=io.BufferedReader(frames, CHUNK), mode="r|") as tar:
            for info in tar:
                name = info.name.removeprefix("./")
                if ".." in name:
                    error = "invalid member name"
                    break
                if name and info.isreg():
                    found.append((name.removeprefix("/"), info.size, info.offset_data))
    except Exception as exc:  # a broken archive is a reported row, the others go on
        error = f"extract: {exc}"
    if frames is not None:
        ends = [*frames.starts[1:], frames.stored()]
        for name, size, offset in found:
            first = bisect_right(frames.offsets, offset) - 1
            last = max(first, bisect_right(frames.offsets, offset + size - 1) - 1)
            at = frames.starts[first]
            yield path, name, size, at, ends[last] - at, offset - frames.offsets[first], None
    if error:
        yield path, None, None, None, None, None, error


def _batches(rows: Iterable[tuple], schema: pa.Schema, payload: int | None = None) -> Iterator[pa.RecordBatch]:
    out, held = [], 0

    def made():
        columns = [pa.array(values, f.type) for values, f in zip(zip(*out), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        out.append(row)
        held += len(row[payload] or b"") if payload is not None else 0
        if len(out) >= FLUSH_ROWS or held >= FLUSH_BYTES:
            yield made()
            out, held = [], 0
    if out:
        yield made()


def index_archives(paths: DataFrame) -> DataFrame:
    """Index of the archives listed in ``path``; store it before it is used several times.

    Each archive is unpacked once, by one task, and its payloads are dropped. A row with an
    ``error`` ends an archive that cannot be read on.
    """
    ship_package(paths.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _batches(_indexed(path), INDEX_SCHEMA)

    tasks = 4 * paths.sparkSession.sparkContext.defaultParallelism
    return paths.select("path").repartition(tasks).mapInArrow(run, INDEX)


def stored_bytes(index: DataFrame) -> DataFrame:
    """Stored bytes that reading the members of `index` takes, per archive.

    Frames are counted once; where members span several frames, each such stretch is.
    """
    stretches = index.where("error is null").groupBy("archive", "at").agg(F.max("span").alias("span"))
    return stretches.groupBy("archive").agg(F.sum("span").cast("bigint").alias("bytes"))


def _read(archive: str, rows: list[tuple]) -> Iterator[tuple]:
    """Payloads of members of one archive, whose rows come in the order of their frames."""
    fs, location = filesystem(archive)
    with fs.open_input_file(location) as file:
        place = data = None
        for member, size, at, span, skip in rows:
            if place != (at, span):
                file.seek(at)
                raw, parts = file.read(span), []
                while raw:
                    unpacker = _unpacker(archive)
                    parts.append(unpacker.decompress(raw))
                    if not unpacker.eof:
                        raise EOFError(f"{archive}: frame at {at} is cut off")
                    raw = unpacker.unused_data
                place, data = (at, span), b"".join(parts)
            yield archive, member, size, data[skip : skip + size]


def read_members(index: DataFrame) -> DataFrame:
    """``archive, member, size, payload`` of the indexed members; filter `index` to read fewer.

    Rows of one archive are cut into parts of about `PART_BYTES` stored bytes, dealt to as many
    tasks as any shuffle. A task holds the frames of one member, or one frame of many.
    """
    spark = index.sparkSession
    ship_package(spark)
    kinds = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("payload", pa.binary())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held, archive = [], None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("archive", "member", "size", "at", "span", "skip"))
            for name, *row in zip(*columns, strict=True):
                if held and (name != archive or len(held) >= FLUSH_ROWS):
                    yield from _read(archive, held)
                    held = []
                archive = name
                held.append(tuple(row))
        if held:
            yield from _read(archive, held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), kinds, 3)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = whole_div("at", F.lit(PART_BYTES)).alias("part")
    chosen = index.where("error is null").select("archive", "member", "size", "at", "span", "skip", part)
    dealt = chosen.repartition(partitions, "archive", "part").sortWithinPartitions("archive", "at", "span", "skip")
    return dealt.drop("part").mapInArrow(run, MEMBERS)

