"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens, served in units. With each window a queue's credit grows
by its share of the window; what is due and not yet served is its deficit. The unit served
next is always the one most overdue, so a window holds each source's target within a unit,
and deficits carry over to the next window. What all queues have been served before a window
has a closed form (:meth:`Mixture.served`), so any task can go on from any window with the
right deficits: documents are cut where they are, without a shuffle of tokens.

What is left when fewer units than a window remain, and the last partial unit of each queue,
fills closing sequences one source after another; the very last is cut into powers of two,
which need no padding.

Rows
----
Null and empty texts are a document of the end id alone. A null source is the queue ''.
Repeated rows are packed each; null ids are returned. Extra columns are left out. An empty
table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.common import broadcast_within
from .common import slices, stored, strings
from .word_tokens import token_bytes

WINDOW = 4096
# Tokens per unit: the finest cut between sources, and the most a window may be off its target.
UNIT = 64
# Windows whose state a task works out at once.
BLOCK = 64

TOKENS = "doc_id bigint, part bigint, source string, place bigint, n_ids bigint, ids binary"
PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


class Mixture:
    """Where each queue stands at each window.

    `totals` are the tokens per source; `weights` the target proportions, by default those of
    the totals. A queue that runs empty leaves its share to the others.
    """

    def __init__(self, totals: dict[str, int], weights: dict[str, int] | None = None):
        self.sources = sorted(totals)
        self.index = {s: k for k, s in enumerate(self.sources)}
        self.tokens = [totals[s] for s in self.sources]
        self.units = [t // UNIT for t in self.tokens]
        self.rates = [weights[s] for s in self.sources] if weights else self.units
        if any(r <= 0 < u for r, u in zip(self.rates, self.units, strict=True)):
            raise ValueError("every source needs a positive weight")
        # Queues in the order in which they run empty, with what is served and active then.
        self._order = sorted(
            (k for k, u in enumerate(self.units) if u), key=lambda k: (self.units[k] / self.rates[k], k)
        )
        self._limits, gone, active = [], 0, sum(self.rates[k] for k in self._order)
        for k in self._order:
            # Units served in all when queue k runs empty, rounded up.
            self._limits.append(gone - -self.units[k] * active // self.rates[k])
            gone, active = gone + self.units[k], active - self.rates[k]
        self.windows = sum(self.units) // (WINDOW // UNIT)
        self.block = lru_cache(maxsize=64)(self._block)
        self.start = lru_cache(maxsize=4096)(lambda number: self.served(number * BLOCK))
        ends = self.served(self.windows)
        left = [t - c * UNIT for t, c in zip(self.tokens, ends, strict=True)]
        self.tail_from = [c * UNIT for c in ends]
        self.tail_base = [0, *accumulate(left)][:-1]
        rest = sum(left)
        self.tail_ends = [WINDOW * k for k in range(1, rest // WINDOW + 1)]
        for power in range(WINDOW.bit_length() - 2, -1, -1):
            if rest % WINDOW >> power & 1:
                self.tail_ends.append((self.tail_ends[-1] if self.tail_ends else 0) + (1 << power))

    def served(self, window: int) -> list[int]:
        """Units of each queue served before `window`.

        Unit ``c`` of a queue is due at time ``(2c + 1) / (2 rate)``; the units due earliest
        have been served, equal times in the order of the sources.
        """
        wanted = window * WINDOW // UNIT
        empty = bisect_right(self._limits, wanted)
        full = self._order[:empty]
        due = wanted - sum(self.units[k] for k in full)
        active = sum(self.rates[k] for k in self._order[empty:])
        counts = [0] * len(self.sources)
        for k in full:
            counts[k] = self.units[k]
        for k in self._order[empty:]:
            counts[k] = min(self.units[k], (2 * due * self.rates[k] + active) // (2 * active))
        short = wanted - sum(counts)
        scale = 1 << 80  # due times as integers: exact to far below the gap of two times
        if short > 0:
            # The next unit of each queue by its due time; the earliest are served.
            due_next = [((2 * counts[k] + 1) * scale // self.rates[k], k) for k in self._order if counts[k] < self.units[k]]
            heapify(due_next)
            for _ in range(short):
                k = heappop(due_next)[1]
                counts[k] += 1
                if counts[k] < self.units[k]:
                    heappush(due_next, ((2 * counts[k] + 1) * scale // self.rates[k], k))
        elif short < 0:
            # The last unit of each queue; the latest are taken back.
            served_last = [(-((2 * counts[k] - 1) * scale // self.rates[k]), -k) for k in self._order if counts[k]]
            heapify(served_last)
            for _ in range(-short):
                k = -heappop(served_last)[1]
                counts[k] -= 1
                if counts[k]:
                    heappush(served_last, (-((2 * counts[k] - 1) * scale // self.rates[k]), -k))
        return counts

    def _block(self, number: int) -> np.ndarray:
        """:meth:`served` for the windows of a block and the one after it."""
        low = number * BLOCK
        return np.array([self.served(w) for w in range(low, min(low + BLOCK, self.windows) + 1)], np.int64)

    def window_of(self, k: int, unit: int) -> int:
        """The window that takes a unit of queue `k`."""
        low, high = 0, (self.windows - 1) // BLOCK
        while low < high:  # the last block that starts at or before the unit
            middle = (low + high + 1) // 2
            if self.start(middle)[k] <= unit:
                low = middle
            else:
                high = middle - 1
        counts = self.block(low)[:, k]
        return low * BLOCK + int(np.searchsorted(counts, unit, side="right")) - 1

    def pieces(self, source: str, place: int, size: int) -> Iterator[tuple[int, int, int, int]]:
        """``(start, length, sequence, offset)`` of `size` tokens at `place` of a queue."""
        k, start, end = self.index[source], place, place + size
        window = None
        while start < min(end, self.tail_from[k]):
            if window is None or window >= self.windows:
                window = self.window_of(k, start // UNIT)
            block = self.block(window // BLOCK)
            before, after = block[window % BLOCK], block[window % BLOCK + 1]
            stop = min(end, int(after[k]) * UNIT)
            if stop > start:
                offset = int((after[:k] - before[:k]).sum()) * UNIT + start - int(before[k]) * UNIT
                yield start - place, stop - start, window, offset
                start = stop
                window += 1
            else:  # the queue has no turn here; look up its next one
                window = None
        while start < end:
            at = self.tail_base[k] + start - self.tail_from[k]
            number = bisect_right(self.tail_ends, at)
            low = self.tail_ends[number - 1] if number else 0
            stop = min(end, start + self.tail_ends[number] - at)
            yield start - place, stop - start, self.windows + number, at - low
            start = stop


def tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Stored ids of every document, two or four bytes each, with the document's ``place``
    among those of its source in its ``part``, which is the task that wrote it."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = TaskContext.get().partitionId(), {}
        for batch in slices(batches, "text"):
            sources, places, sizes, ids = strings(batch, "source"), [], [], []
            for source, found in zip(sources, token_bytes(batch.column("text"), tokenizer), strict=True):
                found += end
                places.append(filled.get(source, 0))
                sizes.append(len(found) // 4)
                filled[source] = places[-1] + sizes[-1]
                numbers = np.frombuffer(found, "<u4")
                ids.append(numbers.astype("<u2").tobytes() if numbers.max() < 1 << 16 else found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(sources, pa.string()),
                    pa.array(places, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "part", "source", "place", "n_ids", "ids"],
            )

    return stored(docs.mapInArrow(run, TOKENS), "packing-tokens")


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    weights: dict[str, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per piece of a document in a sequence.

    The mixture, one number per source, is the only thing that reaches the driver.
    """
    rows = tokens(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(text_col).cast("string").alias("text"),
            F.col(source_col).cast("string").alias("source"),
        ),
        tokenizer,
        end_id,
    )
    filled = stored(rows.groupBy("part", "source").agg(F.sum("n_ids").alias("total")), "packing-totals")
    totals = {r.source: r.total for r in filled.groupBy("source").agg(F.sum("total").alias("total")).collect()}
    mixture = Mixture(totals, weights)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    placed = rows.join(broadcast_within(filled.select("part", "source", base)), ["part", "source"])
    plan = (mixture.sources, mixture.tokens, mixture.rates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources, counts, rates = plan
        own = Mixture(dict(zip(sources, counts, strict=True)), dict(zip(sources, rates, strict=True)))
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 6]
        names = [field.split()[0] for field in PIECES.split(", ")]
        for batch in slices(batches, "ids"):
            out = []
            for doc_id, source, place, size, ids in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "source", "place", "n_ids", "ids")), strict=True
            ):
                raw = np.frombuffer(ids, "<u2" if len(ids) == 2 * size else "<u4").astype("<u4").tobytes()
                for start, length, sequence, offset in own.pieces(source, place, size):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    out.append((doc_id, source, start, length, crc, size, sequence, offset))
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return placed.select(
        "doc_id", "source", (F.col("place") + F.col("base")).alias("place"), "n_ids", "ids"
    ).mapInArrow(run, PIECES)
