"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one node with a number of its own; shards hold at most a fixed number of nodes
on average, dealt by a hash of the vector. A shard's graph is stored as flat arrays, per level the
offsets of every node's neighbours and the neighbours. Shards are dealt to tasks by number.
Queries go to every shard as a sorted stream behind its graph, so a task holds one graph and one
query at a time; the shards' best are merged per query.

Rows
----
Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows with a null id. Vectors are compared within one length. Equal scores go to the smaller
id. A repeated id is one query and one candidate: its vector nearest to the query counts, and its
rows ask together. Extra columns are left out. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

# Nodes per shard on average.
SHARD = 8192
# Neighbours per node and level (twice as many on the lowest), and beam widths.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 80, 128

INDEX = "dim int, shard int, place int, ids binary, vectors binary, entry int, offsets array<binary>, links array<binary>"


class Graph:
    """The flat form of a graph, for searches."""

    def __init__(self, vectors: np.ndarray, entry: int, offsets: list[np.ndarray], links: list[np.ndarray]):
        self.vectors, self.entry, self.offsets, self.links = vectors, entry, offsets, links

    def search(self, query: np.ndarray, beam: int = SEARCH_BEAM) -> list[int]:
        """Nodes near a unit vector, at most `beam`, in no order."""
        vectors, node = self.vectors, self.entry
        best = float(vectors[node] @ query)
        for level in range(len(self.links) - 1, 0, -1):
            offsets, links = self.offsets[level], self.links[level]
            while True:
                near = links[offsets[node] : offsets[node + 1]]
                if not len(near):
                    break
                scores = vectors[near] @ query
                k = int(scores.argmax())
                if scores[k] <= best:
                    break
                node, best = int(near[k]), float(scores[k])
        offsets, links = self.offsets[0], self.links[0]
        seen = np.zeros(len(vectors), bool)
        seen[node] = True
        todo, found = [(-best, node)], [(best, node)]
        while todo:
            score, node = heappop(todo)
            if -score < found[0][0] and len(found) >= beam:
                break
            near = links[offsets[node] : offsets[node + 1]]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            for score, node in zip((vectors[near] @ query).tolist(), near.tolist()):
                if len(found) < beam:
                    heappush(found, (score, node))
                elif score > found[0][0]:
                    heapreplace(found, (score, node))
                else:
                    continue
                heappush(todo, (-score, node))
        return [node for _, node in found]


def _beam(vectors, links, query, entries, width):
    """Best-first search over lists of neighbours; ``(score, node)``, best first."""
    seen = {node for _, node in entries}
    todo = [(-score, node) for score, node in entries]
    found = list(entries)
    todo.sort()
    found.sort()
    while todo:
        score, node = heappop(todo)
        if -score < found[0][0] and len(found) >= width:
            break
        near = [x for x in links[node] if x not in seen]
        if not near:
            continue
        seen.update(near)
        for score, node in zip((vectors[near] @ query).tolist(), near):
            if len(found) < width:
                heappush(found, (score, node))
            elif score > found[0][0]:
                heapreplace(found, (score, node))
            else:
                continue
            heappush(todo, (-score, node))
    return sorted(found, reverse=True)


def _diverse(vectors: np.ndarray, ranked: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours that are nearer to the node than to each other, filled up with the nearest."""
    nodes = [node for _, node in ranked]
    if len(nodes) <= most:
        return nodes
    among = vectors[nodes] @ vectors[nodes].T
    kept: list[int] = []
    closest = np.full(len(nodes), -np.inf, np.float32)
    for k, (score, _) in enumerate(ranked):
        if closest[k] < score:
            kept.append(k)
            if len(kept) == most:
                break
            np.maximum(closest, among[k], out=closest)
    if len(kept) < most:
        chosen = set(kept)
        kept += [k for k in range(len(nodes)) if k not in chosen][: most - len(kept)]
    return [nodes[k] for k in kept]


def build(vectors: np.ndarray, ids: np.ndarray) -> Graph:
    """Insert unit vectors one after another; a node's top level follows from its id."""
    n = len(vectors)
    uniform = [(xxhash.xxh3_64_intdigest(int(i).to_bytes(8, "little", signed=True)) + 1) / (2**64 + 1) for i in ids]
    tops = [int(-np.log(u) / np.log(LINKS)) for u in uniform]
    levels: list[dict[int, list[int]]] = []
    entry, top = 0, -1
    for node in range(n):
        query, own = vectors[node], tops[node]
        while len(levels) <= own:
            levels.append({})
        if top >= 0:
            at = [(float(vectors[entry] @ query), entry)]
            for level in range(top, own, -1):
                at = _beam(vectors, levels[level], query, at[:1], 1)
            for level in range(min(top, own), -1, -1):
                links, most = levels[level], LINKS * (1 if level else 2)
                at = _beam(vectors, links, query, at, BUILD_BEAM)
                links[node] = _diverse(vectors, at, LINKS)
                for other in links[node]:
                    back = links[other]
                    back.append(node)
                    if len(back) > most + LINKS // 2:
                        scores = (vectors[back] @ vectors[other]).tolist()
                        links[other] = _diverse(vectors, sorted(zip(scores, back), reverse=True), most)
        for level in range(max(top, -1) + 1, own + 1):
            levels[level][node] = []
        if own > top:
            entry, top = node, own
    offsets, flat = [], []
    for links in levels:
        sizes = np.array([len(links.get(k, ())) for k in range(n)], np.int32)
        offsets.append(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        flat.append(np.array([x for k in range(n) for x in links.get(k, ())], np.int32))
    return Graph(vectors, entry, offsets, flat)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in single precision."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def cosine(one: np.ndarray, other: np.ndarray) -> float:
    """Cosine in double precision."""
    return float(one @ other / (np.sqrt(one @ one) * np.sqrt(other @ other)))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    fit = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return fit.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def index(rows: DataFrame, kept_ids: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``(nodes, graphs)`` of :func:`usable` rows.

    A node is a distinct vector with its `kept_ids` smallest ids: more are never asked for.
    """
    spark = rows.sparkSession
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = (
        rows.distinct()
        .withColumn("rank", rank)
        .where(F.col("rank") <= kept_ids)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("same"))
        .select(
            F.size("vector").alias("dim"),
            F.monotonically_increasing_id().alias("node"),  # fixed by being stored
            F.xxhash64("vector").alias("mark"),
            "vector",
            "same",
        )
    )
    nodes = stored(nodes, "small-world-nodes")
    # One row per length: its shards, and how many shards stand before them.
    before = F.coalesce(F.sum("shards").over(Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    shards = shards.withColumn("before", before.cast("int"))
    placed = nodes.join(shards, "dim").withColumn("shard", F.pmod("mark", "shards").cast("int"))
    placed = placed.withColumn("place", F.col("before") + F.col("shard"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, list[float]]] = []
        key = None

        def made():
            ids = np.array([i for i, _, _ in held], np.int64)
            vectors = np.array([v for _, _, v in held], np.float64)
            graph = build(unit(vectors), np.array([m for _, m, _ in held], np.int64))
            row = {
                "dim": key[0],
                "shard": key[1],
                "place": key[2],
                "ids": ids.tobytes(),
                "vectors": vectors.tobytes(),
                "entry": graph.entry,
                "offsets": [x.tobytes() for x in graph.offsets],
                "links": [x.tobytes() for x in graph.links],
            }
            types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("dim", "shard", "place", "node", "mark", "vector"))
            for dim, shard, place, node, mark, vector in zip(*columns, strict=True):
                if held and key != (dim, shard, place):
                    yield made()
                    held = []
                key = (dim, shard, place)
                held.append((node, mark, vector))
        if held:
            yield made()

    dealt = _dealt(placed.select("dim", "shard", "place", "node", "mark", "vector"))
    graphs = dealt.sortWithinPartitions("place", "mark", "node").mapInArrow(run, INDEX)
    return nodes, stored(graphs, "small-world-graphs")


def _dealt(rows: DataFrame) -> DataFrame:
    """Shards, numbered by ``place``, over the partitions of the session in turn."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(partitions, F.col("place") % partitions)


def search(queries: DataFrame, nodes: DataFrame, graphs: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the `k` nearest of each query but itself.

    `queries` has ``query_id, vector``.
    """
    places = graphs.select("dim", "place")
    graph_columns = [F.col(c) for c in ("ids", "vectors", "entry", "offsets", "links")]
    empty = [F.lit(None).cast(graphs.schema[c].dataType).alias(c) for c in ("ids", "vectors", "entry", "offsets", "links")]
    asked = queries.select(F.size("vector").alias("dim"), "query_id", "vector").join(places, "dim")
    stream = graphs.select(
        "place", F.lit(None).cast("bigint").alias("query_id"), F.lit(None).cast("array<double>").alias("vector"), *graph_columns
    ).unionByName(asked.select("place", "query_id", "vector", *empty))
    stream = _dealt(stream).sortWithinPartitions("place", F.col("query_id").asc_nulls_first())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = ids = wide = None
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                query_id = batch.column("query_id")[row].as_py()
                if query_id is None:
                    get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                    ids = np.frombuffer(get("ids"), np.int64)
                    wide = np.frombuffer(get("vectors"), np.float64).reshape(len(ids), -1)
                    arrays = [[np.frombuffer(x, np.int32) for x in get(name)] for name in ("offsets", "links")]
                    graph = Graph(unit(wide), get("entry"), *arrays)
                    continue
                vector = np.array(batch.column("vector")[row].as_py(), np.float64)
                near = graph.search(unit(vector[None])[0], max(SEARCH_BEAM, 4 * k))
                scored = sorted((-cosine(vector, wide[x]), int(ids[x])) for x in near)[: k + 1]
                out += [(query_id, node, -score) for score, node in scored]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "node", "score"])

    found = stream.mapInArrow(run, "query_id bigint, node bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.join(nodes.select("dim", "node", "same"), "node")
        .select("query_id", "score", F.explode("same").alias("vec_id"))
        .where("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The `k` nearest of every row whose id is divisible by `every`, among all rows."""
    rows = usable(vectors, id_col, vector_col)
    nodes, graphs = index(rows, k + 1)
    queries = rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    return search(queries, nodes, graphs, k)
