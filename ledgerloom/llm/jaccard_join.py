"""N-gram Jaccard join with rare-first prefixes.

Two sets that are similar enough share a token among the rarest few of each, so only these
prefixes are joined. The order is rare-first by how often tokens of a hash bucket occur in
the whole corpus (a table of fixed size), then by hash; any order gives the same links. Pairs
that meet are filtered by length, by the place of the shared token, and by how the rest of
both sets spreads over hash regions (suffix filter); what remains is verified once per pair.

Equal sets are one class, represented by its smallest document id. Within a large group of
near copies every pair would meet, so links are found in two steps: first each class meets
the class that stands foremost at a shared token, then only classes of different
components meet. Pairs within a component can't change it; all others are still tried, so no
link between different components is lost.

Rows
----
Words are runs of other characters than white space, A-Z lower-cased. A text of fewer words
than an n-gram is one n-gram; null, empty and blank texts have none and link with nothing.
A row with a null id links with nothing and has no component. Rows are judged each, also if
they repeat an id. Extra columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import broadcast_within
from ..session import small_batches
from .common import slices, stored, strings, text_columns
from .components import connected

# Buckets of the frequency table: 16 MB, whatever the corpus.
BUCKET_BITS = 22
# The table travels in slices of so many buckets.
SLICE_BITS = 16
# Buckets of tokens that a task holds before it counts them, 8 bytes each.
HELD = 1 << 19
# Pairs of ids that are sent to all tasks at most, 32 MB of them; more are shuffled.
PAIR_ROWS = 2_000_000
# Hash regions of the suffix filter.
REGIONS = 16

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]

SETS = "doc_id bigint, n int, d1 bigint, d2 bigint, slice int, counts binary"
ENTRIES = "token bigint, d1 bigint, d2 bigint, n int, place int"


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text."""
    found = text.encode().lower().split()  # lowers A-Z and splits at \\x20 and \\x09-\\x0D alone
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(hashes))
    last = len(hashes) - size + 1
    total = np.full(last, size, np.uint64)
    for k in range(size):
        total = (total ^ (total >> np.uint64(29))) * _MIX[1] + hashes[k : k + last] * _MIX[0]
    total = (total ^ (total >> np.uint64(32))) * _MIX[2]
    return np.unique(total ^ (total >> np.uint64(29)))


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def _longs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def _buckets(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count(counts: np.ndarray, held: list[np.ndarray]) -> None:
    """Add the buckets in `held` to `counts`, without another table of all buckets."""
    buckets, times = np.unique(np.concatenate(held), return_counts=True)
    counts[buckets] += times.astype(counts.dtype)


def prefix_length(n: int, percent: int) -> int:
    """A set of `n` shares at least ``percent`` of itself with a similar one, so one of these."""
    return n - -(-percent * n // 100) + 1


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """Size and digest of every set, and each task's bucket counts."""
    names = [field.split()[0] for field in SETS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        held: list[np.ndarray] = []
        for batch in slices(batches, "text"):
            found = [shingles(t, words) for t in strings(batch, "text")]
            held.append(_buckets(np.concatenate(found)))
            if sum(map(len, held)) >= HELD:
                _count(counts, held)
                held = []
            d1, d2 = _longs([_digest(f) for f in found])
            size, none = len(found), pa.nulls
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array(d1),
                    pa.array(d2),
                    none(size, pa.int32()),
                    none(size, pa.binary()),
                ],
                names,
            )
        if held:
            _count(counts, held)
        parts = counts.reshape(-1, 1 << SLICE_BITS)
        used = np.flatnonzero(parts.any(axis=1)).tolist()
        size, none = len(used), pa.nulls
        yield pa.RecordBatch.from_arrays(
            [
                none(size, pa.int64()),
                none(size, pa.int32()),
                none(size, pa.int64()),
                none(size, pa.int64()),
                pa.array(used, pa.int32()),
                pa.array([zlib.compress(parts[k].tobytes(), 1) for k in used], pa.binary()),
            ],
            names,
        )

    return rows.mapInArrow(run, SETS)


def _frequencies(sets: DataFrame) -> np.ndarray:
    """Occurrences per bucket over all documents; a table of fixed size."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.uint64)
                totals[k] = totals[k] + part if k in totals else part
        raw = [zlib.compress(np.minimum(t, 2**32 - 1).astype(np.uint32).tobytes(), 1) for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(raw, pa.binary())], ["slice", "counts"])

    # Tasks add up what they have before slices meet, one task per slice at most.
    parts = sets.where("slice is not null").select("slice", "counts").mapInArrow(add, "slice int, counts binary")
    table = np.zeros((1 << (BUCKET_BITS - SLICE_BITS), 1 << SLICE_BITS), np.uint32)
    for row in parts.repartition("slice").mapInArrow(add, "slice int, counts binary").collect():
        table[row.slice] = np.frombuffer(zlib.decompress(bytes(row.counts)), np.uint32)
    return table.reshape(-1)


def _prefixes(rows: DataFrame, words: int, percent: int, frequencies) -> DataFrame:
    """One row per prefix token of every set, in rare-first order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequencies.value
        names = [field.split()[0] for field in ENTRIES.split(", ")]
        for batch in slices(batches, "text"):
            found = [f for f in (shingles(t, words) for t in strings(batch, "text")) if len(f)]
            if not found:
                continue
            tokens = []
            for f in found:
                first = np.lexsort((f, often[_buckets(f)]))[: prefix_length(len(f), percent)]
                tokens.append(f[first])
            lengths = np.array([len(t) for t in tokens])
            d1, d2 = _longs([_digest(f) for f in found])
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            columns = [
                np.concatenate(tokens).view(np.int64),
                np.repeat(d1, lengths),
                np.repeat(d2, lengths),
                np.repeat(np.array([len(f) for f in found], np.int32), lengths),
                places.astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    return rows.select("text").mapInArrow(run, ENTRIES)


def _full_sets(rows: DataFrame, words: int) -> DataFrame:
    """``rid, n, regions, tokens``: whole sets and their counts per hash region."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [shingles(t, words) for t in strings(batch, "text")]
            regions = [np.bincount((f & np.uint64(REGIONS - 1)).astype(np.int64), minlength=REGIONS) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array(regions, pa.list_(pa.int32())),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                ["rid", "n", "regions", "tokens"],
            )

    return rows.mapInArrow(run, "rid bigint, n int, regions array<int>, tokens binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``) whose sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                one = np.frombuffer(left.as_buffer(), np.uint64)
                other = np.frombuffer(right.as_buffer(), np.uint64)
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Pairs are two numbers each, sets are long: up to PAIR_ROWS pairs go to the sets, and only one
    # set per pair, and those it is compared with, move.
    one = sets.select(F.col("rid").alias("a"), F.col("tokens").alias("left")).join(broadcast_within(pairs, PAIR_ROWS), "a")
    heads = broadcast_within(pairs.select("b").distinct(), PAIR_ROWS)
    other = sets.select(F.col("rid").alias("b"), F.col("tokens").alias("right")).join(heads, "b", "left_semi")
    return one.join(other, "b").select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def _needed(percent: int):
    """Common tokens that sets of sizes ``l.n`` and ``r.n`` need."""
    return F.ceil(F.lit(percent) * (F.col("l.n") + F.col("r.n")) / (100 + percent) - F.lit(1e-9)).cast("int")


def _possible(percent: int):
    """Whether rows ``l`` and ``r`` that share a token can be similar, by length and place.

    If the shared token is their first in common, no more can be common than stand from there
    on in either set.
    """
    n, m = F.col("l.n"), F.col("r.n")
    length = (F.lit(100) * n >= F.lit(percent) * m) & (F.lit(100) * m >= F.lit(percent) * n)
    place = F.least(n - F.col("l.place"), m - F.col("r.place")) >= _needed(percent)
    return (F.col("l.rid") != F.col("r.rid")) & length & place


def _suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose tokens can lie alike: what the counts per region differ by can't be common."""
    light = sets.select("rid", "n", "regions")
    apart = F.aggregate(
        F.zip_with("l.regions", "r.regions", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x
    )
    return (
        pairs.join(light.alias("l"), F.col("a") == F.col("l.rid"))
        .join(light.alias("r"), F.col("b") == F.col("r.rid"))
        .where(apart <= F.col("l.n") + F.col("r.n") - 2 * _needed(percent))
        .select("a", "b")
    )


def _pair(one: str, other: str):
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def jaccard_join(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` of every document.

    ``class_id`` is the smallest document with the same set, ``component_id`` the smallest
    document that links lead to, over sets of `words`-word n-grams of at least `percent`
    hundredths Jaccard similarity.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = text_columns(docs, id_col, text_col)
    sets = stored(_sets(rows, words), "jaccard-sets")
    own = sets.where("slice is null").select("doc_id", "n", "d1", "d2")
    known = own.where("doc_id is not null and n > 0")
    classes = stored(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("rid")), "jaccard-classes")

    frequencies = spark.sparkContext.broadcast(_frequencies(sets))
    entries = _prefixes(rows.where("doc_id is not null"), words, percent, frequencies)
    # Tokens in the prefixes of at least two documents; the same set twice is one row afterwards.
    shared = entries.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    met = entries.join(shared.select("token"), "token", "left_semi").distinct()
    postings = stored(met.join(classes, ["d1", "d2"]).select("token", "rid", "n", "place"), "jaccard-postings")
    possible = _possible(percent)
    same_token = F.col("l.token") == F.col("r.token")
    # Whole sets of the classes that have a partner to try, with one shuffle of texts.
    live = postings.alias("l").join(postings.alias("r"), same_token & possible, "left_semi")
    live = stored(live.select(F.col("rid").alias("doc_id")).distinct(), "jaccard-live")
    full = stored(_full_sets(rows.join(live, "doc_id", "left_semi"), words), "jaccard-full")

    # The foremost class of each token: it has the fewest rarer tokens, like the common origin of copies.
    foremost = stored(
        postings.groupBy("token").agg(F.min_by("rid", F.struct("place", "rid")).alias("first")), "jaccard-foremost"
    )
    heads = postings.join(foremost, "token").where("rid = first").drop("first")
    met_first = postings.alias("l").join(heads.alias("r"), same_token & possible).select(*_pair("l.rid", "r.rid"))
    tried = stored(_suffix_filter(met_first.distinct(), full, percent), "jaccard-first")
    links = stored(_verified(tried, full, percent), "jaccard-links")

    placed = _with_component(postings, connected(links))
    # Of two classes in different components at least one isn't in that of the token's foremost.
    leading = placed.join(foremost, "token").where("rid = first").select("token", F.col("component").alias("leading"))
    apart = placed.join(leading, "token").where("component <> leading").drop("leading")
    met_later = (
        apart.alias("l")
        .join(placed.alias("r"), same_token & (F.col("l.component") != F.col("r.component")) & possible)
        .select(*_pair("l.rid", "r.rid"))
    )
    rest = _suffix_filter(met_later.distinct().join(tried, ["a", "b"], "left_anti"), full, percent)
    rest = stored(rest, "jaccard-later")
    links = links.unionAll(stored(_verified(rest, full, percent), "jaccard-more-links"))
    components = connected(links)

    rids = own.join(classes, ["d1", "d2"], "left")
    return rids.join(components, rids.rid == components.node, "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rid", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rid", "doc_id")).alias("component_id"),
    )


def _with_component(postings: DataFrame, components: DataFrame) -> DataFrame:
    joined = postings.join(components, postings.rid == components.node, "left")
    return stored(
        joined.select(*postings.columns, F.coalesce("component", "rid").alias("component")), "jaccard-placed"
    )
