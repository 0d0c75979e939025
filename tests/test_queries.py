"""Every registered query against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as entry_point
from ledgerloom.catalog.queries import QUERIES
from oracle import compare, connect, types

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
# Nothing is sealed among the few heads of the smallest tables.
LARGER = {
    "sealed_batches",
    "late_heights",
    "resume_point",
    "save_progress",
    "sealed_batches_stream",
    "stream_resume",
    "stream_sink",
    "stream_gap_counts",
    "late_heights_stream",
}
SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connections():
    return {sf: connect(f"{DATA}/{sf}") for sf in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connections, name):
    sf = "sf0.01" if name in LARGER else "sf0.001"
    result = QUERIES[name](spark, f"{DATA}/{sf}")
    ours, theirs = types(connections[sf], SQL[name], result)
    assert ours == theirs
    assert compare(connections[sf], SQL[name], result) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["batch_start", "n_heights", "n_shards"]
    assert result.count() > 0


@pytest.mark.parametrize(
    "name, rows",
    [("missing_heights", 392), ("empty_runs", 385), ("parse_archives", 138), ("missing_ranges", 35), ("copy_plan", 100)],
)
def test_known_counts(spark, name, rows):
    assert QUERIES[name](spark, f"{DATA}/sf0.01").count() == rows
