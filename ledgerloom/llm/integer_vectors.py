"""Vectors as integers: ``floor(factor * component)``, packed into bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "vec_id bigint, dim int, x binary"

# Rows a task works on at once.
BLOCK = 4096


def _packed(row: np.ndarray) -> bytes:
    """Four bytes a component where all fit, else eight; equal vectors have equal bytes."""
    wide = len(row) and (row.max() > 2**31 - 1 or row.min() < -(2**31))
    return row.astype("<i8" if wide else "<i4").tobytes()


def integers(df: DataFrame, factor: int, limit: int, length: int | None = None, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """``vec_id, dim, x`` of the vectors that have components, all of them finite, with `factor` a power of two.

    With a `length`, vectors of other lengths are left out, too. A component whose integer is
    `limit` or more in size raises a ValueError: results derived from it would not be exact.
    Null vectors, empty ones and those with a null or non-finite component give no row. Null and
    repeated ids stay.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            fit = (sizes > 0) & (bad[ends] == bad[ends - sizes])
            if length is not None:
                fit &= sizes == length
            rows = np.flatnonzero(fit)
            whole = np.floor(flat * factor) + 0.0
            out = []
            for row in rows.tolist():
                part = whole[ends[row] - sizes[row] : ends[row]]
                if np.abs(part).max() >= limit:
                    raise ValueError(f"vector {batch.column('vec_id')[row]} has a component of {limit / factor:g} or more")
                out.append(_packed(part.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(sizes[rows].astype(np.int32)), pa.array(out, pa.binary())],
                names=["vec_id", "dim", "x"],
            )

    chosen = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return chosen.mapInArrow(run, SCHEMA)


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Length, rows and integer matrix of the vectors of one length, `BLOCK` of them at most."""
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            part = batch.slice(low, BLOCK)
            dims = part.column("dim").to_numpy()
            sizes = pc.binary_length(part.column("x")).to_numpy()
            for dim in np.unique(dims).tolist():
                for width in (4, 8):
                    rows = np.flatnonzero((dims == dim) & (sizes == width * dim))
                    if len(rows):
                        some = part if len(rows) == part.num_rows else part.take(pa.array(rows))
                        joined = b"".join(some.column("x").to_pylist())
                        yield dim, some, np.frombuffer(joined, f"<i{width}").reshape(-1, dim).astype(np.int64)


def sums(rows: DataFrame, groups: str, run) -> DataFrame:
    """Exact ``n`` and ``total`` per ``group, place`` of the partial sums that `run` gives per task.

    `run` maps batches to ``group, n, sums``; numbers are added as decimals of 38 digits.
    """
    partial = rows.mapInArrow(run, "group int, n bigint, sums array<bigint>")
    spread = partial.select("group", "n", F.posexplode("sums").alias("place", "part"))
    wide = "decimal(38,0)"
    return spread.groupBy(F.col("group").alias(groups), "place").agg(
        F.sum(F.col("n")).alias("n"), F.sum(F.col("part").cast(wide)).cast(wide).alias("total")
    )


def partial_batch(found: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """What a task has summed, for :func:`sums`."""
    keys = sorted(found)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int32()),
            pa.array([found[k][0] for k in keys], pa.int64()),
            pa.array([found[k][1].tolist() for k in keys], pa.list_(pa.int64())),
        ],
        names=["group", "n", "sums"],
    )
