"""Exact token counts at every prefix, by prefix dynamic programming.

The last token of a prefix decides the rest: a piece can end a prefix exactly if it stands
beside the last token of the prefix before it without merging. One such piece exists for
every prefix, so ``count[i] = count[i - len(piece)] + tokens of the piece``. Counts at all
prefixes are stored as one signed byte per character, the change to the count before;
truncation and budgets are answered from these bytes without encoding again.

Rows
----
Null and empty texts count 0 tokens. Repeated rows are counted each; a null id is returned as
it is. Extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordCache, slices, strings, text_columns
from .piece_model import PieceModel, load

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, prefix_counts binary, chars_within bigint"

# Pairs of neighbouring pieces whose verdict a worker remembers.
PAIRS = 1_000_000


class PrefixCounter:
    """Token counts at every prefix of a segment."""

    def __init__(self, model: PieceModel):
        self._model = model
        self._pairs: dict[tuple[str, str], bool] = {}

    def _stands(self, left: str, right: str) -> bool:
        """Whether `right` stays a token of its own after `left` ('' for the start)."""
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        found = self._model.symbols(left + right) == ([left, right] if left else [right])
        self._pairs[left, right] = found
        return found

    def counts(self, segment: str) -> list[int]:
        ids, tails, pairs = self._model.ids, self._model.tails, self._pairs
        counts, last = [0], [""]
        for i in range(1, len(segment) + 1):
            for low in range(i - 1, -1, -1):
                piece = segment[low:i]
                if piece in ids:
                    cost = 1
                elif low == i - 1:
                    cost = len(piece.encode())
                elif piece in tails:
                    continue
                else:
                    raise AssertionError(f"no last token for {segment[:i]!r}")
                stands = pairs.get((last[low], piece))
                if self._stands(last[low], piece) if stands is None else stands:
                    counts.append(counts[low] + cost)
                    last.append(piece)
                    break
        return counts


_caches: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    """Word to the changes of the count over its characters, its leading mark included."""
    if path not in _caches:
        model = load(path)
        counter = PrefixCounter(model)

        def changes(segment: str) -> bytes:
            counts = counter.counts(segment)
            return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])

        found = WordCache(lambda fresh: [changes(s) for s in fresh])

        def words(fresh: list[str]) -> list[bytes]:
            lists = [model.segments(w) for w in fresh]
            known = found.lookup(lists)
            return [b"".join(map(known.__getitem__, segments)) for segments in lists]

        _caches[path] = WordCache(words)
    return _caches[path]


def prefix_changes(texts: list[str], path: str) -> list[bytes]:
    """One signed byte per character of each text: tokens up to it, less tokens before it."""
    model = load(path)
    lists = [model.words(t) for t in texts]
    known = _cache(path).lookup(lists)
    out = []
    for words in lists:
        whole = b"".join(map(known.__getitem__, words))
        if whole:  # the mark put in front of the text has no character of its own
            first = np.frombuffer(whole[:2], np.int8).astype(int).sum()
            whole = np.int8(first).tobytes() + whole[2:]
        out.append(whole)
    return out


def count_at(changes: bytes, chars: int) -> int:
    """Tokens of the first `chars` characters."""
    return int(np.frombuffer(changes, np.int8)[:chars].sum(dtype=np.int64))


def chars_within(changes: bytes, budget: int) -> int:
    """Length of the longest prefix of at most `budget` tokens."""
    counts = np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def prefix_counts(
    docs: DataFrame, model_path: str, budget: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, prefix_counts, chars_within`` of every whole text.

    ``chars_within`` is the length of the longest prefix of at most `budget` tokens; other
    budgets are answered by :func:`fitting_chars` from ``prefix_counts``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = strings(batch, "text")
            changes = prefix_changes(texts, model_path)
            totals = [int(np.frombuffer(c, np.int8).sum(dtype=np.int64)) for c in changes]
            within = [
                len(t) if total <= budget else chars_within(c, budget)
                for t, c, total in zip(texts, changes, totals, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(changes, pa.binary()),
                    pa.array(within, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "prefix_counts", "chars_within"],
            )

    return text_columns(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def fitting_chars(prefix: str | Column, budget: int) -> Column:
    """Length of the longest prefix within another budget, from stored prefix counts."""

    @F.pandas_udf("bigint")
    def within(column: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else chars_within(c, budget) for c in column], dtype="Int64")

    return within(prefix)
