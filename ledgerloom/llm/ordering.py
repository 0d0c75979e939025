"""Rows in the order of their ids, spread over partitions without one big sort."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ranges per shuffle partition, so that hashing ranges to partitions evens out.
RANGES = 4

# Share of a range by which the cuts may be off.
ERROR = 0.1


def id_cuts(docs: DataFrame, id_col: str = "doc_id") -> list[int]:
    """Ascending ids that cut `docs` into ranges of about equal row counts.

    Their number follows the shuffle partitions of the session; only sketches reach the driver.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = docs.select(F.col(id_col).cast("bigint").alias("id")).approxQuantile("id", shares, ERROR / ranges)
    return sorted({int(c) for c in cuts})


def range_of(ids: pa.Array, cuts: list[int]) -> np.ndarray:
    """Range number of each id; null ids count as the smallest."""
    known = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    return np.searchsorted(np.array(cuts, np.int64), known, side="right").astype(np.int32)


def with_range(docs: DataFrame, cuts: list[int]) -> DataFrame:
    """`docs`, which has ``doc_id``, with its ``part``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(range_of(batch.column("doc_id"), cuts)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, part int")


def in_order(rows: DataFrame, *order) -> DataFrame:
    """Rows of a ``part`` together, parts and rows in order within each partition."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "part").sortWithinPartitions("part", *order)
