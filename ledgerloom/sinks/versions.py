"""Batch tables whose batches are replaced all at once, by one commit.

Rows of a batch lie in a folder per version, ``data/batch_start=/batch_end=/version=``; those of a
write of very many batches in folders of neighbours, ``grouped/range_start=/range_end=/version=``. A
snapshot lists the version of every batch; a commit is one small file, made only if its number is
free, that names a snapshot. Readers take the snapshot of the highest whole commit, so a write
that was killed leaves the old table, and a reader keeps the versions it began with until
:meth:`VersionedTable.vacuum` removes what nobody has pointed to for a grace period.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..operators.common import of_batches
from ..session import exists, hadoop_path
from . import digests
from .batches import balanced, binned, stored_order, totals
from .groups import GROUP, first_of, folders, group_width, grouped

BATCH = ["batch_start", "batch_end"]
SNAPSHOT = "batch_start bigint, batch_end bigint, version string"
_VERSIONED = [*BATCH, "version"]

# A version whose batches share folders ends in the width of these, in heights.
_WIDTH = r"-w([0-9]+)$"

# Times a commit is tried again after another one came first.
RETRIES = 20


class Conflict(RuntimeError):
    """Another commit has replaced one of the same batches."""


@dataclass(frozen=True)
class Staged:
    """Rows written under a version that no snapshot names yet, and what went in."""

    version: str
    parent: int
    totals: dict
    schema: StructType
    width: int = 0


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- commits

    def _children(self, name: str):
        found, store = hadoop_path(self.spark, f"{self.path}/{name}")
        return list(store.listStatus(found)) if store.exists(found) else []

    def _text(self, status) -> str:
        _, store = hadoop_path(self.spark, self.path)
        stream = store.open(status.getPath())
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commits(self) -> dict[int, str]:
        """Snapshot by commit number. A commit that was cut short counts for nothing."""
        out = {}
        for status in self._children("commits"):
            name = status.getPath().getName()
            if name.isdigit() and (text := self._text(status)).endswith("\n"):
                out[int(name)] = json.loads(text)["snapshot"]
        return out

    def head(self) -> int:
        """Number of the newest commit, 0 before the first."""
        return max(self.commits(), default=0)

    def _publish(self, number: int, snapshot: str) -> bool:
        """Whether commit `number` was still free and is now ours."""
        target, store = hadoop_path(self.spark, f"{self.path}/commits/{number:012d}")
        try:
            stream = store.create(target, False)
        except Py4JJavaError as error:
            if store.exists(target):
                return False
            raise error
        stream.write(bytearray(json.dumps({"snapshot": snapshot}).encode() + b"\n"))
        stream.close()
        return True

    # --- reading

    def snapshot(self, at: int | None = None) -> DataFrame:
        """``batch_start, batch_end, version`` of the newest commit, or of commit `at`."""
        known = self.commits()
        if at is None:
            at = max(known, default=0)
        if at == 0:
            return self.spark.createDataFrame([], SNAPSHOT)
        return self.spark.read.schema(SNAPSHOT).parquet(f"{self.path}/snapshots/{known[at]}")

    def read(self, at: int | None = None, schema: StructType | None = None) -> DataFrame:
        """Rows of the newest commit, or of commit `at`; only folders it names are read.

        With a `schema`, a table without any commit can be read, too.
        """
        at = self.head() if at is None else at
        if at == 0:
            if schema is None:
                raise ValueError(f"{self.path} has no commit")
            return self.spark.createDataFrame([], schema)
        snapshot, width = self.snapshot(at), _width("version")
        parts = []
        if not exists(self.spark, f"{self.path}/grouped"):
            parts.append((self._rows(schema), snapshot, _VERSIONED))
        else:
            inside = snapshot.where(width.isNotNull()).withColumn("range_start", first_of("batch_start", width))
            # Folders of other groups and versions are pruned by the listing of those that are named.
            parts.append((self._rows(schema, GROUP), inside, [*_VERSIONED, "range_start"]))
            if exists(self.spark, f"{self.path}/data"):
                parts.append((self._rows(schema), snapshot.where(width.isNull()), _VERSIONED))
        found = []
        for rows, named, on in parts:
            # The join puts its keys in front.
            kept = [c for c in rows.columns if c not in ("version", "range_start")]
            found.append(of_batches(rows, named, on).select(*kept))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)

    def _rows(self, schema: StructType | None = None, by: list[str] = BATCH) -> DataFrame:
        """Rows of all versions, of those with folders `by` batch or group."""
        reader, keys = self.spark.read, _VERSIONED if by == BATCH else [*_VERSIONED, "range_start"]
        if schema is not None:
            wanted = StructType([f for f in schema if f.name not in BATCH])
            for name in dict.fromkeys([*BATCH, *by]):
                wanted = wanted.add(name, LongType())
            reader = reader.schema(wanted.add("version", StringType()))
        rows = reader.parquet(f"{self.path}/{'data' if by == BATCH else 'grouped'}")
        kept = [c for c in rows.columns if c not in (*_VERSIONED, *GROUP)]
        typed = [F.col(c).cast("string" if c == "version" else "bigint").alias(c) for c in keys]
        return rows.select(*kept, *typed)

    # --- writing

    def stage(
        self, df: DataFrame, start: int = 0, size: int = 1, codec: str = "zstd", batches: DataFrame | None = None
    ) -> Staged:
        """Write rows under a new version. Readers do not see them before :meth:`commit`.

        `batches` may list the batches of `df`, or more, where they are cheaper to count there.
        """
        parent = self.head()
        rows = binned(df, start, size)
        width = group_width(rows if batches is None else batches)
        version = f"v{parent + 1}-{uuid.uuid4().hex[:12]}" + (f"-w{width}" if width else "")
        seen = Observation()
        ordered = stored_order(balanced(grouped(rows, width), width), width)
        counted = ordered.observe(seen, *(c.alias(n) for n, c in totals(rows).items()))
        writer = counted.withColumn("version", F.lit(version)).write.mode("append").option("compression", codec)
        writer.partitionBy(*folders(width), "version").parquet(f"{self.path}/{'grouped' if width else 'data'}")
        return Staged(version, parent, seen.get, rows.schema, width)

    def staged(self, staged: Staged) -> DataFrame:
        """What was written under a version, read back."""
        if not staged.totals["files"]:
            return self.spark.createDataFrame([], staged.schema)
        rows = self._rows(staged.schema, GROUP if staged.width else BATCH).where(F.col("version") == staged.version)
        return rows.select(*(f.name for f in staged.schema))

    def damaged(self, staged: Staged, df: DataFrame, start: int = 0, size: int = 1) -> DataFrame | None:
        """Batches whose written rows are not those of `df`; None if all are intact.

        One read back tells whether all is well; only otherwise `df` is run again to name batches.
        """
        back = self.staged(staged)
        row = back.agg(*(c.alias(n) for n, c in totals(back).items())).first()
        if row.asDict() == staged.totals:
            return None
        found = digests.damaged_heights(
            digests.height_digests(binned(df, start, size)), digests.height_digests(back)
        )
        return found.select(*BATCH).distinct()

    def commit(self, staged: Staged, batches: DataFrame | None = None) -> int:
        """Make staged batches the current ones, all at once; `batches` picks some of them.

        Returns the number of the commit. Raises :class:`Conflict` if one of the batches was
        replaced since they were staged; commits to other batches are taken along.
        """
        fresh = self.staged(staged).select(*BATCH).distinct()
        if batches is not None:
            fresh = fresh.join(batches.select(*BATCH), BATCH, "left_semi")
        name = f"{staged.version}-batches"
        fresh.withColumn("version", F.lit(staged.version)).write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")
        fresh = self.spark.read.schema(SNAPSHOT).parquet(f"{self.path}/snapshots/{name}")
        before = self.snapshot(staged.parent)
        for _ in range(RETRIES):
            head = self.head()
            current = self.snapshot(head)
            if head != staged.parent:
                moved = current.join(before, _VERSIONED, "left_anti")
                if not moved.join(fresh, BATCH, "left_semi").isEmpty():
                    raise Conflict(f"{self.path}: batches were replaced by commit {head} or one before it")
            # A commit that was cut short keeps its number.
            taken = [int(s.getPath().getName()) for s in self._children("commits") if s.getPath().getName().isdigit()]
            number = max(taken, default=0) + 1
            snapshot = f"{number:012d}-{uuid.uuid4().hex[:12]}"
            after = current.join(fresh, BATCH, "left_anti").unionByName(fresh)
            after.write.parquet(f"{self.path}/snapshots/{snapshot}")
            if self._publish(number, snapshot):
                return number
        raise Conflict(f"{self.path}: other commits kept coming first")

    def replace(self, df: DataFrame, start: int = 0, size: int = 1, codec: str = "zstd") -> int:
        """Stage, verify and commit `df`, which may read from this table.

        If the read-back fails, nothing is committed and an error names how many batches differ.
        """
        staged = self.stage(df, start, size, codec)
        damaged = self.damaged(staged, df, start, size)
        if damaged is not None:
            raise RuntimeError(f"{self.path}: {damaged.count()} staged batches do not hold what was written")
        return self.commit(staged)

    # --- keeping trees of digests

    def write_digests(self) -> int:
        """Keep the digest tree of the newest commit, for :meth:`audit`. Returns its number."""
        number = self.head()
        digests.write_tree(digests.height_digests(self.read(number)), f"{self.path}/digests/{number:012d}")
        return number

    def audit(self, number: int) -> DataFrame:
        """Heights of commit `number` that no longer hold what its digest tree says."""
        wanted = digests.read_tree(self.spark, f"{self.path}/digests/{number:012d}")
        return digests.damaged_in_trees(wanted, digests.digest_tree(digests.height_digests(self.read(number))))

    # --- clearing up

    def _folders(self, version: str = "*"):
        listed = []
        for top, (first, last) in (("data", BATCH), ("grouped", GROUP)):
            found, store = hadoop_path(self.spark, f"{self.path}/{top}/{first}=*/{last}=*/version={version}")
            listed += store.globStatus(found) or []
        return store, listed

    def forget(self, staged: Staged) -> int:
        """Remove what was staged but not committed under a version. Returns the number of folders."""
        named = self._named(self.commits().values(), staged.version)
        store, folders = self._folders(staged.version)
        gone = [f for f in folders if _key(f) not in named]
        for folder in gone:
            store.delete(folder.getPath(), True)
        return len(gone)

    def _named(self, snapshots, version: str | None = None) -> set[tuple]:
        """First and last heights and versions of the folders that snapshots name."""
        out: set[tuple] = set()
        for name in snapshots:
            rows = self.spark.read.schema(SNAPSHOT).parquet(f"{self.path}/snapshots/{name}")
            if version:
                rows = rows.where(F.col("version") == version)
            width = _width("version")
            low = F.when(width.isNull(), F.col("batch_start")).otherwise(first_of("batch_start", width))
            high = F.when(width.isNull(), F.col("batch_end")).otherwise(low + (width - 1))
            out.update(tuple(r) for r in rows.select(low, high, "version").distinct().collect())
        return out

    def vacuum(self, grace_sec: float = 7 * 86_400) -> int:
        """Remove versions and commits older than the grace period, but for the newest commit.

        What is younger stays, so that running readers and writers keep what they use. Returns
        the number of version folders removed.
        """
        limit = (time.time() - grace_sec) * 1000
        known = self.commits()
        newest = max(known, default=0)
        old = {n for n in known if n != newest}
        statuses = {int(s.getPath().getName()): s for s in self._children("commits") if s.getPath().getName().isdigit()}
        # A commit ends when the next one begins.
        ends = {n: min((statuses[m].getModificationTime() for m in known if m > n), default=0) for n in old}
        expired = {n for n in old if ends[n] < limit}
        kept = {n: name for n, name in known.items() if n not in expired}
        named = self._named(kept.values())
        store, folders = self._folders()
        gone = [f for f in folders if _key(f) not in named and f.getModificationTime() < limit]
        for n in sorted(expired):
            store.delete(statuses[n].getPath(), False)
        for folder in gone:
            store.delete(folder.getPath(), True)
        for status in self._children("snapshots"):
            if status.getPath().getName() not in kept.values() and status.getModificationTime() < limit:
                store.delete(status.getPath(), True)
        return len(gone)


def _key(status) -> tuple:
    path = status.getPath()
    parts = [path.getParent().getParent().getName(), path.getParent().getName(), path.getName()]
    first, last, version = (p.split("=", 1)[1] for p in parts)
    return int(first), int(last), version


def _width(version: str) -> Column:
    """Heights per folder of a version whose batches share them, null for any other."""
    return F.nullif(F.regexp_extract(version, _WIDTH, 1), F.lit("")).cast("bigint")
