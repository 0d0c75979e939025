"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

# Texts are handled in slices of about this many bytes, so that a task's Python memory
# depends on its longest text and not on how many rows Arrow puts into a batch.
SLICE_BYTES = 1 << 20

# Distinct words a worker remembers per generation of its cache; two generations exist.
CACHE_WORDS = 400_000

# Longer words are encoded each time.
CACHE_CHARS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; the package is made importable on the executors first."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the folder all executors share and read it back.

    The result has no lineage, so a lost executor costs nothing but the tasks it ran.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about `limit` bytes of `text`."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                yield batch.slice(low, high - low)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """Texts of a column; null counts as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


class WordCache:
    """What a function gives for each distinct word, remembered in two generations.

    `encode` takes a list of distinct words and returns one value per word.
    """

    def __init__(self, encode: Callable[[list[str]], list], size: int = CACHE_WORDS):
        self._encode, self._size = encode, size
        self._old: dict = {}
        self._now: dict = {}
        self._long: list[str] = []

    def lookup(self, lists: list[list[str]]) -> dict:
        """A mapping that holds all words of `lists`, valid until the next call."""
        for word in self._long:
            del self._now[word]
        if len(self._now) > self._size:
            self._old, self._now = self._now, {}
        now, old = self._now, self._old
        new: set[str] = set()
        for words in lists:
            new.update(set(words).difference(now))
        fresh = []
        for word in new:
            if word in old:
                now[word] = old[word]
            else:
                fresh.append(word)
        now.update(zip(fresh, self._encode(fresh), strict=True))
        self._long = [w for w in fresh if len(w) > CACHE_CHARS]
        return now

    def values(self, distinct: list[str]) -> list:
        """What the function gives for each of some distinct words, where that is never None."""
        for word in self._long:
            del self._now[word]
        if len(self._now) > self._size:
            self._old, self._now = self._now, {}
        now, found = self._now, list(map(self._now.get, distinct))
        if self._old:
            for k in [k for k, value in enumerate(found) if value is None]:
                value = self._old.get(distinct[k])
                if value is not None:
                    found[k] = now[distinct[k]] = value
        places = [k for k, value in enumerate(found) if value is None]
        fresh = [distinct[k] for k in places]
        for k, word, value in zip(places, fresh, self._encode(fresh), strict=True):
            found[k] = now[word] = value
        self._long = [w for w in fresh if len(w) > CACHE_CHARS]
        return found


def text_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text under fixed names; other columns, whatever their names, are left out."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """`names`, with underscores behind them where `df` has such a column already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
