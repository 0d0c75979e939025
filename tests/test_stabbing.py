"""Heights against ranges of any length, by brute force."""

import random

from pyspark.sql import functions as F

from ledgerloom.operators import stabbing

RANGES = "name string, first bigint, last bigint"


def test_cells_tile_their_range(spark):
    random.seed(4)
    pairs = [(0, 0), (5, 5), (0, 7), (1, 6), (3, 3_000_000_000), (7, 2)] + [
        tuple(sorted((random.randrange(5000), random.randrange(5000)))) for _ in range(60)
    ]
    rows = spark.createDataFrame([(str(k), a, b) for k, (a, b) in enumerate(pairs)], RANGES)
    found = {}
    for r in stabbing.cells(rows).collect():
        found.setdefault(r.name, []).append((r.cell << r.power, (r.cell + 1 << r.power) - 1))
    for k, (a, b) in enumerate(pairs):
        cells = sorted(found.get(str(k), []))
        assert (cells[0][0], cells[-1][1]) == (a, b) if b >= a else not cells
        assert all(x[1] + 1 == y[0] for x, y in zip(cells, cells[1:])) and len(cells) <= 2 * 62


def test_covering_nested_overlapping_and_equal_ranges(spark):
    random.seed(5)
    ranges = [(f"r{k}", a, a + random.choice([0, 3, 90, 700])) for k, a in enumerate(random.randrange(1000) for _ in range(80))]
    ranges += [("all", 0, 10_000), ("same", 10, 20), ("twin", 10, 20), ("none", 9, 3), ("far", 2**60, 2**60 + 5)]
    heights = [random.randrange(-20, 2200) for _ in range(300)] + [None, 2**60 + 5, 15, 15]
    left = spark.createDataFrame([(h, k) for k, h in enumerate(heights)], "height bigint, n int")
    got = stabbing.covering(left, spark.createDataFrame(ranges, RANGES))
    assert got.columns == ["height", "n", "name", "first", "last"]
    want = sorted((h, k, *r) for k, h in enumerate(heights) for r in ranges if h is not None and h >= 0 and r[1] <= h <= r[2])
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_holders_and_empty_sides(spark):
    ranges = spark.createDataFrame([("a", 0, 9), ("b", 5, 6)], RANGES)
    heights = spark.createDataFrame([(5,), (5,), (9,), (10,)], "height bigint")
    assert sorted(map(tuple, stabbing.holders(heights, ranges).collect())) == [(5, 2), (9, 1)]
    assert stabbing.covering(heights, ranges.where(F.lit(False))).collect() == []
    assert stabbing.covering(heights.limit(0), ranges).collect() == []
