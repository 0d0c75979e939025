"""Embedding whitening: blockwise QR, bidiagonal qd values, twisted vectors.

Every distinct integer vector counts once. Tasks reduce their centred rows to one triangle by
QR of block after block, triangles are put together in a tree of bounded fan-in, and the last
one, as large as the vectors are long, gives the singular values by dqds and the directions by
twisted factorisations. Counts, sums and deviations are exact integers.

Rows
----
Rows whose vector is null or empty or holds null or non-finite entries give none. Vectors of
different lengths are whitened on their own, each length with its own fit list. Components
whose eigenvalue is zero, up to rounding, are left out, so n vectors have n - 1 components at
most and a single one none. Null and repeated ids keep their rows. Extra columns are left out.
Empty tables give no rows. A deviation beyond a long is null; an entry of 2^53 or more
(``factor * entry``) raises an error, as it is no exact integer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bidiagonal import leading
from .common import stored
from .integer_vectors import blocks, integers, partial_batch, sums

# Triangles one task puts together.
FAN_IN = 32

# All means and directions together, in bytes; they go to every task.
MAX_MODEL_BYTES = 256 << 20

LIMIT = 2**53

TRIANGLES = "dim int, slot int, r binary"
RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def _triangle(rows: np.ndarray, above: np.ndarray | None) -> np.ndarray:
    """R of the rows below an earlier triangle, square."""
    r = np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")
    missing = rows.shape[1] - len(r)
    return np.vstack([r, np.zeros((missing, rows.shape[1]))]) if missing else r


def _totals(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact sums per dimension, by length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        flushed = 0
        for dim, _, x in blocks(batches):
            if np.abs(x).max() >= 2**40 or flushed > 2**20:  # far from what a long holds
                if found:
                    yield partial_batch(found)
                found, flushed = {}, 0
            n, old = found.get(dim, (0, np.zeros(dim, np.int64)))
            if np.abs(x).max() >= 2**40:
                for row in x:
                    yield partial_batch({dim: (1, row)})
                continue
            found[dim] = (n + len(x), old + x.sum(axis=0))
            flushed += len(x)
        if found:
            yield partial_batch(found)

    out: dict[int, tuple[int, list[int]]] = {}
    for row in sums(fit, "dim", run).collect():
        out.setdefault(row.dim, (row.n, [0] * row.dim))[1][row.place] = int(row.total)
    if sum(8 * 6 * dim for dim in out) > MAX_MODEL_BYTES:
        raise ValueError("vectors of too many lengths")
    return out


def centred(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """``x - S / n``, from exact differences where they fit, so that close vectors far out stay apart."""
    sizes = [abs(t) for t in totals]
    if n * int(np.abs(x).max(initial=0)) + max(sizes) < 2**63:
        return (x * n - np.array(totals, np.int64)) / n
    return x - np.array([t / n for t in totals])


def _triangles(fit: DataFrame, totals: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """One triangle per length, written."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for dim, _, x in blocks(batches):
            found[dim] = _triangle(centred(x, *totals[dim]), found.get(dim))
        slot = TaskContext.get().partitionId()
        dims = sorted(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(dims, pa.int32()),
                pa.array([slot] * len(dims), pa.int32()),
                pa.array([found[d].tobytes() for d in dims], pa.binary()),
            ],
            names=["dim", "slot", "r"],
        )

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        dim, r = int(key[0]), None
        for part in parts.sort_values("slot").r:
            r = _triangle(np.frombuffer(part).reshape(dim, dim), r)
        return pd.DataFrame({"dim": [dim], "slot": [int(key[1])], "r": [r.tobytes()]})

    level = stored(fit.mapInArrow(run, TRIANGLES), "triangles")
    while (level.agg(F.max("slot")).first()[0] or 0) > 0:
        group = F.floor(F.col("slot") / FAN_IN).cast("int").alias("group")
        level = stored(level.groupBy("dim", group).applyInPandas(merge, TRIANGLES), "triangles")
    return level


def _directions(triangles: DataFrame, count: int) -> dict[int, list]:
    """Per length the leading singular values, their vectors and the sum of all squared values."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, r in zip(batch.column("dim").to_pylist(), batch.column("r").to_pylist()):
                values, vectors, total = leading(np.frombuffer(r).reshape(dim, dim), count)
                k = len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dim] * k, pa.int32()),
                        pa.array(range(k), pa.int32()),
                        pa.array(values, pa.float64()),
                        pa.array([total] * k, pa.float64()),
                        pa.array(vectors.T.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["dim", "place", "value", "total", "vector"],
                )

    schema = "dim int, place int, value double, total double, vector array<double>"
    rows = triangles.mapInArrow(run, schema).orderBy("dim", "place").collect()
    out: dict[int, list] = {}
    for row in rows:
        out.setdefault(row.dim, []).append((row.value, np.array(row.vector), row.total))
    return out


def _deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Exact sums of ``(n * x - S)^2`` per row; null beyond a long.

    Arithmetic modulo 2^64 is exact for what fits; floating point tells which do, and rows close
    to the limit are worked out in unbounded integers.
    """
    wrapped = np.array([t & (2**64 - 1) for t in totals], np.uint64)
    gap = x.astype(np.uint64) * np.uint64(n) - wrapped
    exact = (gap * gap).sum(axis=1, dtype=np.uint64)
    rough = n * (x - np.array([t / n for t in totals]))
    size = (rough * rough).sum(axis=1)
    out: list[int | None] = [v if s < 2.0**63 else None for v, s in zip(exact.tolist(), size.tolist())]
    for i in np.flatnonzero(np.abs(size / 2.0**63 - 1) < 1e-3).tolist():
        value = sum((n * int(v) - t) ** 2 for v, t in zip(x[i].tolist(), totals))
        out[i] = value if value < 2**63 else None
    return out


class Whitener:
    """What tasks need: per length the count, sums, scaled directions and shares."""

    def __init__(self, totals: dict[int, tuple[int, list[int]]], found: dict[int, list]):
        self.totals = totals
        self.scaled, self.shares = {}, {}
        for dim, parts in found.items():
            n = totals[dim][0]
            self.scaled[dim] = np.array([v * np.sqrt(n) / s for s, v, _ in parts]).T
            self.shares[dim] = np.array([s * s / total for s, _, total in parts])

    def whitened(self, dim: int, x: np.ndarray) -> np.ndarray:
        return centred(x, *self.totals[dim]) @ self.scaled[dim]


def fit(vectors: DataFrame, components: int = 4) -> tuple[Whitener, float]:
    """The whitener of packed integer vectors and the largest departure from the identity of the
    covariance of whitened distinct vectors."""
    distinct = stored(vectors.select("dim", "x").distinct(), "fit-list")
    totals = _totals(distinct)
    whitener = Whitener(totals, _directions(_triangles(distinct, totals), components) if totals else {})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim, _, x in blocks(batches):
            if dim in whitener.scaled:
                w = whitener.whitened(dim, x)
                first, second = found.get(dim, (0.0, 0.0))
                found[dim] = (first + w.sum(axis=0), second + w.T @ w)
        for dim, (first, second) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([dim] * (first.size + second.size), pa.int32()),
                    pa.array(range(first.size + second.size), pa.int32()),
                    pa.array(np.concatenate([first, second.ravel()])),
                ],
                names=["dim", "place", "part"],
            )

    parts = distinct.mapInArrow(run, "dim int, place int, part double").groupBy("dim", "place").agg(F.sum("part").alias("s"))
    moments: dict[int, dict[int, float]] = {}
    for row in parts.collect():
        moments.setdefault(row.dim, {})[row.place] = row.s
    error = 0.0
    for dim, placed in moments.items():
        n, k = totals[dim][0], whitener.scaled[dim].shape[1]
        values = np.array([placed[i] for i in range(k + k * k)]) / n
        covariance = values[k:].reshape(k, k) - np.outer(values[:k], values[:k])
        error = max(error, float(np.abs(covariance - np.eye(k)).max()))
    return whitener, error


def whiten(
    df: DataFrame, components: int = 4, factor: int = 256, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Each row's leading whitened components with its deviation and the quality of the fit."""
    vectors = stored(integers(df, factor, LIMIT, None, id_col, vec_col), "integer-vectors")
    whitener, error = fit(vectors, components)
    shared = df.sparkSession.sparkContext.broadcast(whitener)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for dim, rows, x in blocks(batches):
            if dim not in model.scaled:
                continue
            w, share = model.whitened(dim, x), model.shares[dim]
            k, n = len(share), model.totals[dim][0]
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n, np.int64)),
                    pa.array(_deviations(x, *model.totals[dim]), pa.int64()).take(pa.array(each)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(share, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, RESULT)
