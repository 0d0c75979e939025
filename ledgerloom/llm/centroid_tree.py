"""Centroid clustering of integer vectors, with a vantage-point tree over the centroids.

Every round builds the tree anew and broadcasts it; its size is that of the centroids, which
`MAX_CENTROID_BYTES` bounds. Each vector walks the tree best first: it opens the node with the
least lower bound, and a node is left out only if its bound is beyond the best distance, so a
node at exactly that distance is opened and ties go to the smaller number. Distances are
integers. Sums per centroid are added within tasks first, then as decimals, so means are exact;
what reaches the driver is a number per centroid and dimension.

Rows
----
Vectors that are null, of another length, or hold null or non-finite components take no part.
A component of 2^17 or more in size raises an error, as squared distances might not fit into a
long. Rows with a null id are assigned, but never start a centroid; rows with a repeated id are
rows of their own, and start centroids in the order of their packed integers. With fewer vectors
than centroids there are as many centroids as vectors; without any id there are no centroids and no
rows. Extra columns are left out. Empty tables
give no rows. An inertia beyond a long is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .integer_vectors import blocks, integers, partial_batch, sums

# Centroids a leaf of the tree holds at most.
LEAF = 4

# Integers below this keep squared distances of up to 64 components within a long.
LIMIT = 2**27

# What is broadcast each round may be this large.
MAX_CENTROID_BYTES = 256 << 20

# Relative slack of the lower bounds, far above the rounding of their square roots.
SLACK = 1e-12

ASSIGNED = "vec_id bigint, cluster int, distance bigint"
RESULT = f"{ASSIGNED}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def _squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances, one column per point."""
    out = np.empty((len(rows), len(points)), np.int64)
    for k, point in enumerate(points):
        gap = rows - point
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


class VantageTree:
    """Inner nodes hold a vantage centroid and the ranges of distances from it of two halves."""

    def __init__(self, points: np.ndarray):
        self.points = points
        # Per node: its centroids (one vantage point, or those of a leaf, ascending), and for
        # each child its number with the least and greatest distance from the vantage point.
        self.members: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        self._build(np.arange(len(points)))

    def _build(self, members: np.ndarray) -> None:
        todo = [(members, None)]
        while todo:
            members, parent = todo.pop()
            node = len(self.members)
            if parent is not None:
                above, low, high = parent
                self.children[above].append((node, low, high))
            self.children.append([])
            if len(members) <= LEAF:
                self.members.append(members)
                continue
            # A point far out sees the others at many different distances.
            far = int(_squared(self.points[members], self.points[members[:1]])[:, 0].argmax())
            vantage, rest = members[far], np.delete(members, far)
            self.members.append(np.array([vantage]))
            away = _squared(self.points[rest], self.points[vantage : vantage + 1])[:, 0]
            order = np.argsort(away, kind="stable")
            for half in np.array_split(order, 2):
                low, high = np.sqrt(away[half].min()), np.sqrt(away[half].max())
                todo.append((np.sort(rest[half]), (node, float(low), float(high))))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, and the squared distance."""
        n = len(rows)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.points))
        # Open nodes of all rows: which row, which node, its lower bound.
        who, node, low = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        while len(who):
            order = np.lexsort((low, who))
            who, node, low = who[order], node[order], low[order]
            first = np.concatenate([[True], who[1:] != who[:-1]])
            opened = [(who[~first], node[~first], low[~first])]
            now, at = who[first], node[first]
            for current in np.unique(at).tolist():
                mine = now[at == current]
                members = self.members[current]
                away = _squared(rows[mine], self.points[members])
                pick = away.argmin(axis=1)
                near, name = away[np.arange(len(mine)), pick], members[pick]
                closer = (near < best[mine]) | ((near == best[mine]) & (name < number[mine]))
                best[mine[closer]], number[mine[closer]] = near[closer], name[closer]
                root = np.sqrt(near.astype(np.float64))
                for child, least, most in self.children[current]:
                    bound = np.maximum(root - most, least - root) - SLACK * (root + most)
                    opened.append((mine, np.full(len(mine), child), np.maximum(bound, 0.0)))
            who, node, low = (np.concatenate(parts) for parts in zip(*opened))
            reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
            keep = low <= reach[who]
            who, node, low = who[keep], node[keep], low[keep]
        return number, best


def _broadcast(vectors: DataFrame, centroids: np.ndarray):
    if centroids.nbytes > MAX_CENTROID_BYTES:
        raise ValueError(f"{len(centroids)} centroids are too many to broadcast")
    return vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    tree = _broadcast(vectors, centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for _, _, rows in blocks(batches):
            numbers, _ = tree.value.nearest(rows)
            order = np.argsort(numbers, kind="stable")
            names, starts, counts = np.unique(numbers[order], return_index=True, return_counts=True)
            totals = np.add.reduceat(rows[order], starts, axis=0)
            for name, count, total in zip(names.tolist(), counts.tolist(), totals):
                n, old = found.get(name, (0, 0))
                found[name] = (n + count, old + total)
        yield partial_batch(found)

    out = centroids.copy()
    for row in sums(vectors, "cluster", run).collect():
        out[row.cluster, row.place] = int(row.total) // row.n
    tree.unpersist()
    return out


def start(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The `k` vectors whose salted ids have the smallest SHA-256 hashes, in that order."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id is not null").orderBy(key, "x").limit(k).collect()
    rows = [np.frombuffer(bytes(r.x), "<i4").astype(np.int64) for r in first]
    return np.array(rows, np.int64)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    tree = _broadcast(vectors, centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, x in blocks(batches):
            numbers, squares = tree.value.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), pa.array(numbers.astype(np.int32)), pa.array(squares)],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.mapInArrow(run, ASSIGNED)


def cluster(
    df: DataFrame,
    k: int = 8,
    rounds: int = 10,
    factor: int = 1024,
    length: int = 64,
    salt: str = "3:",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Every vector with its cluster, distance and inertias, and the digest of its centroid."""
    spark = df.sparkSession
    if length * 4 * LIMIT**2 > 2**63:
        raise ValueError("vectors of this length may have distances beyond a long")
    vectors = stored(integers(df, factor, LIMIT, length, id_col, vec_col), "integer-vectors")
    centroids = start(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    assigned = stored(assign(vectors, centroids), "assigned")
    inertia = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    per_cluster = {r.cluster: int(r.inertia) for r in assigned.groupBy("cluster").agg(inertia).collect()}
    total = sum(per_cluster.values())

    def fitting(value: int) -> int | None:
        return value if value < 2**63 else None

    named = [
        (c, fitting(per_cluster.get(c, 0)), fitting(total), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids.tolist())
    ]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row per centroid.
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def reference_sql(k: int = 8, rounds: int = 10, factor: int = 1024, length: int = 64, salt: str = "3:") -> str:
    """The same clustering in SQL, one pair of steps per round."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    steps = [
        f"""kept as materialized (
    select row_number() over () as r, vec_id,
        list_transform(embedding, lambda e: floor({factor} * e::double)::bigint) as x
    from embeddings where len(embedding) = {length}
        and len(list_filter(embedding, lambda e: e is not null and isfinite(e::double))) = {length}
)""",
        f"""c0 as materialized (
    select row_number() over (order by sha256('{salt}' || vec_id), x) - 1 as c, x
    from kept where vec_id is not null order by c limit {k}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} as materialized (
    select v.r, min({{'d': {square}, 'c': c.c}}) as near from kept v, c{n} c group by v.r
)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} as materialized (
    with parts as (
        select near.c as c, unnest(x) as p, generate_subscripts(x, 1) as i from a{n} join kept using (r)
    ), means as (
        select c, i, sum(p)::hugeint as s, count(*)::hugeint as n from parts group by c, i
    ), moved as (
        select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as x from means group by c
    )
    select old.c, coalesce(moved.x, old.x) as x from c{n} old left join moved on moved.c = old.c
)"""
            )
    last = rounds
    return f"""with {", ".join(steps)}
select vec_id, near.c::integer as cluster, near.d as distance,
    sum(near.d) over (partition by near.c)::bigint as cluster_inertia, sum(near.d) over ()::bigint as inertia,
    sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{last} join kept using (r) join c{last} c on c.c = near.c
"""
