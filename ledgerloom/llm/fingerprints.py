"""Document fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes; a chunk ends where its top bits are zero, more of
them before the normal size and fewer after it, so that sizes stay near normal. Boundaries
depend on the last 32 bytes only, so an insertion moves no boundary further on. A
fingerprint is the set of chunk digests with their lengths, and the likeness of two is the
share of the first one's length whose chunks the second has, too (containment).

Rows
----
Null and empty texts have the empty fingerprint, which is like itself (1.0) and like nothing
else (0.0). The order of documents is by id, then text; repeated rows follow one another. A
row with a null id has no place in the order: its next document counts as empty, and it is
nobody's next. Extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings, text_columns
from .ordering import id_cuts, in_order, range_of

# Bytes of the shortest, the normal and the longest chunk.
SHORTEST, NORMAL, LONGEST = 12, 32, 128
# Zero bits that end a chunk before and after its normal size.
STRICT_BITS, LOOSE_BITS = 6, 4

SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _gear() -> np.ndarray:
    """A 32-bit number per byte value: multiples of an odd constant, mixed."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def rolling(data: bytes) -> np.ndarray:
    """The gear hash after each byte: ``hash = 2 * hash + gear[byte]`` modulo 2**32.

    Sums over windows of 1, 2, 4, 8, 16 and 32 bytes, each from the one before.
    """
    hashes = GEAR[np.frombuffer(data, np.uint8)]
    for width in (1, 2, 4, 8, 16):
        wider = hashes.copy()
        wider[width:] += hashes[:-width] << np.uint32(width)
        hashes = wider
    return hashes


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of `data`, in order; the last is its length."""
    size = len(data)
    if not size:
        return []
    hashes = rolling(data)
    loose_at = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = (loose_at[hashes[loose_at] >> np.uint32(32 - STRICT_BITS) == 0] + 1).tolist()
    loose = (loose_at + 1).tolist()
    out, start, i, j = [], 0, 0, 0
    while size - start > SHORTEST:
        end = min(start + LONGEST, size)
        i = bisect_left(strict, start + SHORTEST, i)
        if i < len(strict) and strict[i] < start + NORMAL:
            end = strict[i]
        else:
            j = bisect_left(loose, start + NORMAL, j)
            if j < len(loose):
                end = min(end, loose[j])
        out.append(end)
        start = end
    if start < size:
        out.append(size)
    return out


def chunks(text: str) -> dict[int, int]:
    """Length of each distinct chunk by its digest."""
    data, found, start = text.encode(), {}, 0
    digest = xxhash.xxh3_64_intdigest
    for end in cuts(data):
        found[digest(data[start:end])] = end - start
        start = end
    return found


def likeness(one: dict[int, int], other: dict[int, int]) -> float:
    """Containment of `one` in `other`, weighted by length."""
    if not one:
        return 0.0 if other else 1.0
    return sum(size for digest, size in one.items() if digest in other) / sum(one.values())


def written(found: dict[int, int]) -> str:
    """A fingerprint as text: ``digest:length`` in the order of the digests."""
    return ",".join([f"{digest:016x}:{size}" for digest, size in sorted(found.items())])


def edited(text: str, following: str) -> str:
    """`text` with its last half replaced by the first as many characters of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _neighbours(docs: DataFrame) -> DataFrame:
    """Rows in the order of their ids within parts, each part followed by a copy of what comes next.

    The copies (``copy``) are the rows with the first id of the following part, and of the
    first part after the last: one id per part.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    limits = id_cuts(known)

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.array(range_of(batch.column("doc_id"), limits))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), part], ["doc_id", "part"])

    firsts = known.select("doc_id").mapInArrow(parts, "doc_id bigint, part int")
    first = {r.part: r.low for r in firsts.groupBy("part").agg(F.min("doc_id").alias("low")).collect()}
    held = sorted(first)
    before = {first[part]: held[k - 1] for k, part in enumerate(held)}  # the first part follows the last

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "part", "copy"]
        starts = pa.array(list(before), pa.int64())
        for batch in slices(batches, "text", 1 << 24):
            ids, text = batch.column("doc_id"), batch.column("text")
            part = pa.array(range_of(ids, limits))
            yield pa.RecordBatch.from_arrays([ids, text, part, pa.array([False] * len(ids))], names)
            again = np.flatnonzero(pc.is_in(ids, starts).to_numpy(zero_copy_only=False))
            if len(again) and len(starts):
                ids, text = ids.take(pa.array(again)), text.take(pa.array(again))
                back = pa.array([before[i] for i in ids.to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([ids, text, back, pa.array([True] * len(ids))], names)

    rows = docs.mapInArrow(deal, "doc_id bigint, text string, part int, copy boolean")
    return in_order(rows, "copy", "doc_id", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def result(doc, following):
        doc_id, text, found = doc
        changed = edited(text, following[0])
        after = chunks(changed)
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            written(found),
            written(after),
            likeness(found, after),
            likeness(found, following[1]),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, waiting_part = None, None
        for batch in slices(batches, "text"):
            out = []
            parts, copies = batch.column("part").to_pylist(), batch.column("copy").to_pylist()
            for doc_id, text, part, copy in zip(
                batch.column("doc_id").to_pylist(), strings(batch, "text"), parts, copies, strict=True
            ):
                if doc_id is None:
                    out.append(result((None, text, chunks(text)), ("", {})))
                    continue
                if copy and (waiting is None or part != waiting_part):
                    continue  # a further row with the first id of the next part
                found = chunks(text)
                if waiting is not None:
                    out.append(result(waiting, (text, found)))
                waiting, waiting_part = (None, None) if copy else ((doc_id, text, found), part)
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return _neighbours(text_columns(docs, id_col, text_col)).mapInArrow(run, SCHEMA)
