"""The shared folder on a cluster, whose master is no local one."""

import os

import pytest

from ledgerloom import session
from ledgerloom.schemas import BATCH_STATS
from ledgerloom.sinks import records


class OnCluster:
    """A session, or its context, that says it runs on a cluster."""

    master = "spark://head:7077"

    def __init__(self, real, folder=None):
        self._real, self._folder = real, folder

    @property
    def sparkContext(self):  # noqa: N802
        return OnCluster(self._real.sparkContext)

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        return self._folder if key == "spark.checkpoint.dir" else self._real.conf.get(key, default)

    def __getattr__(self, name):
        return getattr(self._real, name)


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_mounted_folder_is_shared(spark, tmp_path, scheme):
    cluster = OnCluster(spark, f"{scheme}{tmp_path}/")
    assert session.shared_dir(cluster) == f"{scheme}{tmp_path}"
    assert session.shared_dir(cluster) == f"{scheme}{tmp_path}"
    assert not os.listdir(tmp_path)


def test_results_are_written_to_a_mounted_folder(spark, tmp_path):
    path = session.scratch_path(OnCluster(spark, f"file://{tmp_path}"), "stats")
    records.append_stats(records.batch_stats_rows(spark.sql("select 0L batch_start, 9L batch_end, 3L dirs, 2000000L bytes")), path)
    assert [(r.batch, r.dirs) for r in spark.read.schema(BATCH_STATS).json(path).collect()] == [("0-9", 3)]


def test_a_folder_that_executors_have_each_to_themselves_is_refused(spark, tmp_path, monkeypatch):
    real = session.hadoop_path

    def of_driver(spark, path):
        found, store = real(spark, path.replace("/shared-", "/driver/shared-"))
        store.mkdirs(found)
        return found, store

    monkeypatch.setattr(session, "hadoop_path", of_driver)
    with pytest.raises(ValueError, match="don't share"):
        session.shared_dir(OnCluster(spark, f"file://{tmp_path}"))


def test_a_cluster_needs_a_folder(spark):
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_dir(OnCluster(spark))
