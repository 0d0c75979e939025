"""Token ids of whole texts in files of directly addressable codes, in the order of the ids.

A part holds a range of document ids, a segment of it the ids of consecutive whole documents;
it is one row with its codes (:mod:`direct_codes`) and a directory of its documents. Rows are
stored as Parquet, which any store that Spark writes to can hold. Parts are numbered
upwards, so the place of a document among all is known from the totals of the parts.

Rows
----
Null and empty texts have the end id alone. Documents are ordered by id, rows of one id by
text; null ids come first. Extra columns are left out. An empty table gives no segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import slices, text_columns
from .direct_codes import DirectCodes, encode
from .ordering import id_cuts, in_order, with_range
from .word_tokens import token_bytes

# A segment is closed after the document that brings it to this many ids.
SEGMENT_IDS = 1 << 20

SEGMENTS = (
    "part int, segment int, first bigint, n_ids bigint, doc_ids array<bigint>, n_tokens array<bigint>, codes binary"
)
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def write(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and store all documents; returns the stored segments.

    ``first`` is the place of a segment's first id within its part.
    """
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    names = [field.split()[0] for field in SEGMENTS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, first, doc_ids, sizes, ids = None, 0, 0, [], [], []

        def closed():
            count = sum(sizes)
            codes = encode(np.frombuffer(b"".join(ids), "<u4"))
            row = [part, segment, first, count, doc_ids, sizes, codes]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        held = 0
        for batch in slices(batches, "text"):
            found = token_bytes(batch.column("text"), tokenizer)
            for doc_id, new, encoded in zip(
                batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), found, strict=True
            ):
                if sizes and (new != part or held >= SEGMENT_IDS):
                    yield closed()
                    segment, first = segment + 1, first + held
                    doc_ids, sizes, ids, held = [], [], [], 0
                if new != part:
                    part, segment, first = new, 0, 0
                doc_ids.append(doc_id)
                sizes.append(len(encoded) // 4 + 1)
                ids += [encoded, end]
                held += sizes[-1]
        if sizes:
            yield closed()

    rows = text_columns(docs, id_col, text_col)
    ordered = in_order(with_range(rows, id_cuts(rows)), "doc_id", "text")
    return _stored_plain(ordered.mapInArrow(run, SEGMENTS), "token-files")


def _stored_plain(df: DataFrame, name: str) -> DataFrame:
    """Like ``stored``, without compression: codes are read in place, not unpacked."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "none").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def part_starts(segments: DataFrame) -> DataFrame:
    """``part, base``: ids in all parts before. One row per part, a number the session sets."""
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def lookup(segments: DataFrame, places: DataFrame) -> DataFrame:
    """``doc_id, offset, token_id`` for places in documents (``doc_id, offset``, from 0).

    The directories of the segments, without codes, tell which segment holds a document; of a
    segment that is asked for, codes are read at the wanted places alone. Places beyond a
    document and unknown ids give no row; of rows that repeat an id each answers.
    """
    entry = F.arrays_zip("doc_ids", "n_tokens")
    before = F.aggregate(
        F.slice("n_tokens", 1, F.col("k")), F.lit(0).cast("bigint"), lambda total, size: total + size
    )
    held = segments.select("part", "segment", "n_tokens", F.posexplode(entry).alias("k", "entry")).select(
        "part", "segment", F.col("entry.doc_ids").alias("doc_id"), F.col("entry.n_tokens").alias("size"), before.alias("begin")
    )
    wanted = places.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("offset").cast("bigint").alias("offset"))
    found = held.join(wanted, "doc_id").where((F.col("offset") >= 0) & (F.col("offset") < F.col("size")))
    asked = found.select("part", "segment", "doc_id", "offset", (F.col("begin") + F.col("offset")).alias("at"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, number, out = batch.column("codes"), batch.column("at").to_pylist(), []
            opened, key = None, None
            keys = list(zip(batch.column("part").to_pylist(), batch.column("segment").to_pylist()))
            for k, at in enumerate(number):
                if keys[k] != key:
                    key, opened = keys[k], DirectCodes(codes[k].as_buffer())
                out.append(opened.at(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("offset"), pa.array(out, pa.int64())], ["doc_id", "offset", "token_id"]
            )

    codes = segments.select("part", "segment", "codes")
    joined = asked.join(codes, ["part", "segment"]).select("part", "segment", "doc_id", "offset", "at", "codes")
    return joined.mapInArrow(run, "doc_id bigint, offset bigint, token_id bigint")


def read(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                codes = DirectCodes(batch.column("codes")[k].as_py())
                origin = batch.column("base")[k].as_py() + batch.column("first")[k].as_py()
                doc_ids, sizes = batch.column("doc_ids")[k].as_py(), batch.column("n_tokens")[k].as_py()
                starts = np.cumsum([0, *sizes[:-1]])
                sums = [
                    zlib.crc32(codes.run(start, start + size).astype("<u4").tobytes())
                    for start, size in zip(starts.tolist(), sizes, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(origin + starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return segments.join(F.broadcast(part_starts(segments)), "part").mapInArrow(run, READ)
