"""Random inputs against brute force, with hot keys among them."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import copying, gaps, ranges
from ledgerloom.sources import inventory


@pytest.fixture
def small_slices(monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.common.MAX_SLICES", 7)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_and_coverage(spark, small_slices, seed):
    rng = np.random.default_rng(seed)
    lost = sorted({int(h) for h in rng.integers(10, 400, 300)})
    df = spark.createDataFrame([(h,) for h in lost * 2], "height bigint")
    runs, begin = [], None
    for h in range(10, 402):
        if h in lost and begin is None:
            begin = h
        elif h not in lost and begin is not None:
            runs.append((begin, h - 1, h - begin))
            begin = None
    assert rows(gaps.empty_runs(df, 10, 401)) == runs

    archives = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 380, 25), rng.integers(0, 40, 25))]
    archives += [archives[0]] * 12  # one range holds a third of all archives
    depth = [sum(a <= h <= z for a, z in archives) for h in range(10, 401)]
    want, low = [], 10
    for h in range(10, 401):
        if h == 400 or depth[h - 10] != depth[h - 9]:
            if depth[h - 10] != 1:
                want.append(("overlap" if depth[h - 10] else "gap", low, h, depth[h - 10]))
            low = h + 1
    got = rows(ranges.coverage(spark.createDataFrame(archives, "first bigint, last bigint"), 10, 400))
    # Two archives that meet leave the depth as it is; brute force merges the same way.
    assert got == sorted(want)


@pytest.mark.parametrize("seed", [3, 4])
def test_audit_and_repair(spark, seed):
    rng = np.random.default_rng(seed)

    def members(n, hot):
        heights = [hot if rng.random() < 0.33 else int(rng.integers(0, 60)) for _ in range(n)]
        names = ["block.json" if rng.random() < 0.4 else f"shard_{rng.integers(0, 5)}.json" for _ in range(n)]
        return sorted({(h, m): int(rng.integers(0, 3)) for h, m in zip(heights, names)}.items())

    schema = "height bigint, member string, size bigint"
    primary_rows = [(h, m, s) for (h, m), s in members(150, 7)]
    fallback_rows = [(h, m, s + 10) for (h, m), s in members(150, 8)]
    primary, fallback = spark.createDataFrame(primary_rows, schema), spark.createDataFrame(fallback_rows, schema)
    domain = inventory.height_domain(spark, 0, 59)
    expected_rows = [(h, str(s)) for h in range(60) for s in range(int(rng.integers(0, 4)))]
    expected = spark.createDataFrame(expected_rows, "height bigint, shard_id string")

    def check(df, have):
        missing = {r[0] for r in gaps.missing_heights(domain, df).collect()}
        present = {h for (h, m), s in have.items() if m == "block.json" and s > 0}
        assert missing | present == set(range(60)) and not missing & present
        want = sorted((h, s) for h, s in expected_rows if h in present and have.get((h, f"shard_{s}.json"), 0) <= 0)
        assert rows(gaps.missing_shards(expected, df)) == want
        return missing, {h for h, _ in want}

    have = {(h, m): s for h, m, s in primary_rows}
    missing, broken = check(primary, have)
    wanted = gaps.refetch_set(gaps.missing_heights(domain, primary), gaps.missing_shards(expected, primary))
    assert {r[0] for r in wanted.collect()} == missing | broken

    filled = gaps.fill_gaps(primary, fallback, wanted)
    fetched = {(h, m): s for h, m, s in fallback_rows if h in missing | broken}
    after = have | fetched
    assert rows(filled) == sorted((h, m, s) for (h, m), s in after.items())
    assert rows(gaps.fill_gaps(filled, fallback, wanted)) == rows(filled)

    still, still_broken = check(filled, after)
    batches = spark.range(0, 60, 10).select(F.col("id").alias("batch_start"))
    gate = gaps.complete_batches(
        batches, gaps.missing_heights(domain, filled), gaps.missing_shards(expected, filled), 0, 10
    )
    assert rows(gate) == [(b,) for b in range(0, 60, 10) if not any(h // 10 * 10 == b for h in still | still_broken)]


def test_schedule_and_pages(spark):
    sizes = {f"archives/{i}": (i * 37) % 100 for i in range(3000)}
    df = spark.createDataFrame(list(sizes.items()), "key string, size bigint")
    digest = {k: hashlib.md5(k.encode()).hexdigest() for k in sizes}
    order = sorted(sizes, key=lambda k: (digest[k], k))
    pages = {k: i // 1000 for i, k in enumerate(order)}
    assert rows(copying.delete_manifest(df.union(df), "archives/")) == sorted(pages.items())

    for lanes in (4, 64):  # 64 lanes are too many offsets to broadcast
        used, want = [0] * lanes, []
        for k in order:
            lane = int(digest[k][24:], 16) % lanes
            want.append((k, lane, used[lane] * lanes // 500))
            used[lane] += sizes[k]
        assert rows(copying.copy_schedule(df, lanes, 500)) == sorted(want)
    assert copying.copy_schedule(df, 4, 0).where("slot <> 0").count() == 0


def test_counters_add_up(spark):
    source = spark.createDataFrame(
        [(f"in/{i * 10}-{i * 10 + 9}.tar.{'gz' if i % 3 else 'txt'}", i) for i in range(50)], "key string, size bigint"
    )
    dest = spark.createDataFrame([(f"out/{i * 10}-{i * 10 + 9}.tar.gz",) for i in range(0, 50, 4)], "key string")
    row = copying.copy_counters(source, dest, "in", "out").first()
    assert row.listed == row.skipped_filter + row.skipped_existing + row.copied == 50
    assert row.copied == copying.copy_plan(source, dest, "in", "out").count()
