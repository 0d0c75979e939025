"""Exact line dedup with keep bitmaps.

Line keys become 128-bit hashes. Their rows are range-partitioned and sorted by hash,
document and position, so a stream over a partition meets the first document of a line
first. Cuts between partitions may fall inside a line's documents, so a line in a third of
all documents is spread over many tasks. A partition can't know whether its first line began
in an earlier one; it sets those rows aside and states the smallest document it saw for its
first and its last line. These statements, two per partition, settle the rest.

A document's result is a bitmap of the lines it keeps (bits in the order of the lines,
compressed with zlib), not its text.

Rows
----
Null and empty texts are one empty line. Rows of one id count as one document; each gets the
bitmap of its own text. Rows with a null id take no part and keep all their lines. Extra
columns stay in :func:`apply` and are ignored elsewhere. An empty table gives no bitmaps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, strings, unused

# Shorter keys, in code points, are never dropped.
SHORTEST_KEY = 10

LINES = "high bigint, low bigint, doc_id bigint, digest bigint, n_lines int, places array<int>"
FOUND = f"kind int, {LINES}"
DROP, OPEN, FIRST = 0, 1, 2  # kinds of rows of a partition


def line_keys(text: str, shortest: int = SHORTEST_KEY) -> tuple[int, dict[bytes, list[int]]]:
    """Number of lines, and the places of each key of at least `shortest` code points."""
    found: dict[bytes, list[int]] = {}
    lines = text.encode().lower().split(b"\n")  # lowers A-Z alone
    for place, line in enumerate(lines):
        key = line.strip()  # strips \x20 and \x09-\x0D alone
        if len(key) >= shortest and (key.isascii() or len(key.decode()) >= shortest):
            found.setdefault(key, []).append(place)
    return len(lines), found


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, shortest: int = SHORTEST_KEY) -> DataFrame:
    """One row per key of a document: 128-bit hash, document, digest of its text, places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in LINES.split(", ")]
        for batch in slices(batches, "text"):
            hashes, counts, lines, places = [], [], [], []
            for text in strings(batch, "text"):
                n_lines, found = line_keys(text, shortest)
                hashes += map(xxhash.xxh3_128_digest, found)
                places += found.values()
                counts.append(len(found))
                lines.append(n_lines)
            halves = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
            of = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    batch.column("doc_id").take(of),
                    batch.column("digest").take(of),
                    pa.array(np.repeat(np.array(lines, np.int32), counts)),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names,
            )

    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), _digest(text_col).alias("digest")
    )
    return rows.mapInArrow(run, LINES)


def _digest(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _first_occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted rows of a partition; see the module's text."""
    names = [field.split()[0] for field in FOUND.split(", ")]
    key, owner, opening = None, None, True

    def tagged(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        tags = pa.array(np.full(rows.num_rows, kind, np.int32))
        return pa.RecordBatch.from_arrays([tags, *rows.columns], names)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        high, low, doc = (batch.column(c).to_numpy() for c in ("high", "low", "doc_id"))
        begins = np.empty(len(doc), bool)
        begins[0] = key != (high[0], low[0])
        begins[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts = np.flatnonzero(begins)
        # The first document of the line each row belongs to.
        line = np.cumsum(begins) - 1
        owners = np.where(line >= 0, doc[starts[np.maximum(line, 0)]] if len(starts) else 0, owner or 0)
        if key is None:
            yield tagged(FIRST, batch.slice(0, 1))
            known = int(starts[1]) if len(starts) > 1 else len(doc)
        else:
            known = (int(starts[0]) if len(starts) else len(doc)) if opening else 0
        if known:
            yield tagged(OPEN, batch.slice(0, known))
        opening = opening and known == len(doc)
        dropped = np.flatnonzero((doc != owners) & (np.arange(len(doc)) >= known))
        if len(dropped):
            yield tagged(DROP, batch.take(pa.array(dropped)))
        if len(starts):
            at = int(starts[-1])
            last = batch.slice(at, 1)
        key, owner = (high[-1], low[-1]), int(owners[-1])
    if last is not None:
        yield tagged(FIRST, last)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST_KEY
) -> DataFrame:
    """``doc_id, digest, n_lines, n_dropped, keep`` of the documents that lose lines.

    ``digest`` is the 64-bit hash of the text; documents without a row keep all lines.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("high", "low", "doc_id", "digest")
    # Stored, because the cuts between partitions are chosen in a pass of their own.
    lines = stored(hashed_lines(docs, id_col, text_col, shortest), "lines")
    ranged = lines.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = stored(ranged.mapInArrow(_first_occurrences, FOUND), "line-drops")
    firsts = found.where(F.col("kind") == FIRST).groupBy("high", "low").agg(F.min("doc_id").alias("owner"))
    settled = found.where(F.col("kind") == OPEN).join(F.broadcast(firsts), ["high", "low"])
    places = ("doc_id", "digest", "n_lines", "places")
    drops = (
        found.where(F.col("kind") == DROP)
        .select(*places)
        .unionByName(settled.where(F.col("doc_id") != F.col("owner")).select(*places))
    )
    grouped = drops.groupBy("doc_id", "digest", "n_lines").agg(F.flatten(F.collect_set("places")).alias("places"))

    def bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for size, gone in zip(batch.column("n_lines").to_pylist(), batch.column("places"), strict=True):
                bits = np.ones(size, np.uint8)
                bits[gone.values.to_numpy()] = 0
                keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            dropped = pa.array([len(gone) for gone in batch.column("places")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), batch.column("n_lines"), dropped, pa.array(keep)],
                ["doc_id", "digest", "n_lines", "n_dropped", "keep"],
            )

    return grouped.mapInArrow(bitmaps, "doc_id bigint, digest bigint, n_lines int, n_dropped bigint, keep binary")


def kept_text(text: str, keep: bytes | None) -> str:
    """The lines of `text` that its bitmap keeps."""
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[: len(lines)]
    return "\n".join([line for line, bit in zip(lines, bits.tolist(), strict=True) if bit])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """`docs` with their bitmaps, null where all lines stay, and the new column's name."""
    doc_id, digest, keep = unused(docs, "kept_id", "kept_digest", "kept_lines")
    right = bitmaps.select(F.col("doc_id").alias(doc_id), F.col("digest").alias(digest), F.col("keep").alias(keep))
    same = (F.col(id_col).cast("bigint") == F.col(doc_id)) & (_digest(text_col) == F.col(digest))
    return docs.join(right, same, "left").drop(doc_id, digest), keep


def apply(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the dropped lines taken out of their texts; null texts stay null."""
    joined, keep = with_bitmaps(docs, bitmaps, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [
                text if text is None else kept_text(text, bits)
                for text, bits in zip(batch.column(text_col).to_pylist(), batch.column(keep).to_pylist(), strict=True)
            ]
            at = batch.schema.get_field_index(text_col)
            changed = batch.set_column(at, text_col, pa.array(texts, pa.string()))
            yield changed.drop_columns([keep])

    return joined.mapInArrow(run, docs.schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined, keep = with_bitmaps(rows, keep_bitmaps(rows), "doc_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, dropped, sums = [], [], []
            for text, bits in zip(strings(batch, "text"), batch.column(keep).to_pylist(), strict=True):
                counts.append(text.count("\n") + 1)
                kept = kept_text(text, bits)
                lost = 0
                if bits is not None:
                    flags = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), bitorder="little")
                    lost = counts[-1] - int(flags[: counts[-1]].sum())
                dropped.append(lost)
                sums.append(hashlib.sha256(kept.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sums)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.mapInArrow(run, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
