"""SentencePiece encoding and decoding by a merge agenda, checked against the library.

Rows
----
Null and empty texts have no ids and decode to the empty text. Repeated rows are encoded
each; a null id is returned as it is. Extra columns are left out of the result. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordCache, slices, strings, text_columns
from .piece_model import load

SCHEMA = "doc_id bigint, ids array<int>, decoded string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

_caches: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    """Word to its ids, four bytes each; kept as long as the Python worker lives."""
    if path not in _caches:
        model = load(path)

        def checked(fresh: list[str]) -> list[bytes]:
            """Ids by the agenda, compared with the library before they are used."""
            ours = [model.encode_segment(s) for s in fresh]
            theirs = model.library_segment_ids(fresh)
            if ours != theirs:
                wrong = next(s for s, a, b in zip(fresh, ours, theirs, strict=True) if a != b)
                raise ValueError(f"the agenda and the library encode {wrong!r} differently")
            return [array("i", ids).tobytes() for ids in ours]

        found = WordCache(checked)

        def words(fresh: list[str]) -> list[bytes]:
            lists = [model.segments(w) for w in fresh]
            known = found.lookup(lists)
            return [b"".join(map(known.__getitem__, segments)) for segments in lists]

        _caches[path] = WordCache(words)
    return _caches[path]


def encoded(texts: list[str], path: str) -> list[list[int]]:
    """Ids of each text."""
    model = load(path)
    lists = [model.words(t) for t in texts]
    known = _cache(path).lookup(lists)
    return [array("i", b"".join(map(known.__getitem__, words))).tolist() for words in lists]


def _decoded(ids: list[list[int]], path: str) -> list[str]:
    """Texts of ids, compared with the library's."""
    model = load(path)
    texts = [model.decode(i) for i in ids]
    if texts != model.library.decode(ids, num_threads=1):
        raise ValueError("the library decodes some ids to another text")
    return texts


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = encoded(strings(batch, "text"), model_path)
            decoded = _decoded(ids, model_path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    return text_columns(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same work as :func:`encode_decode`, with digests in place of ids and texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = encoded(strings(batch, "text"), model_path)
            counts = list(map(len, ids))
            decimals = load(model_path).decimals
            sums = [hashlib.sha256(",".join(map(decimals.__getitem__, i)).encode()).hexdigest() for i in ids]
            texts = [hashlib.sha256(t.encode()).hexdigest() for t in _decoded(ids, model_path)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums), pa.array(texts)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_columns(docs, id_col, text_col).mapInArrow(run, DIGESTS)
