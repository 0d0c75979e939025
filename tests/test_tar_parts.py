"""Archives in parts: indexes of frames, reads of chosen members, damage outside of what is read."""

import io
import os
import tarfile

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sinks import archives as tar_sink
from ledgerloom.sources import tar, tar_parts


def packed(spark, codec, heights=40, shard=60_000):
    rows = [(h, m, os.urandom(n)) for h in range(heights) for m, n in (("block.json", 50), ("shard_0.json", shard), ("shard_1.json", 0))]
    folder = scratch_path(spark, "parts")
    df = spark.createDataFrame(rows, "height bigint, member string, payload binary")
    tar_sink.pack_archives(df, folder, 0, 1000, codec)
    return folder, {f"{h:012d}/{m}": bytes(p) for h, m, p in rows}


def contents(df):
    return {r.member: bytes(r.payload) for r in df.collect()}


@pytest.mark.parametrize("codec", ["zstd", "gzip"])
def test_one_archive_is_read_by_many_tasks(spark, codec, monkeypatch):
    monkeypatch.setattr(tar_parts, "PART_BYTES", 1 << 18)
    folder, want = packed(spark, codec)
    index = tar_sink.archive_index(spark, folder)
    assert index.select("archive").distinct().count() == 1 and index.select("at").distinct().count() > 2
    read = tar_parts.read_members(index)
    assert contents(read) == want
    assert read.select(F.spark_partition_id()).distinct().count() > 1
    # Other programs read the archive as one stream.
    whole = tar.expand_archives(index.select(F.col("archive").alias("path")).distinct())
    assert {r.member: bytes(r.payload) for r in whole.collect()} == want


@pytest.mark.parametrize("codec", ["zstd", "gzip"])
def test_headers_take_a_tenth_of_the_bytes_at_most(spark, codec):
    folder, want = packed(spark, codec)
    index = tar_sink.archive_index(spark, folder)
    headers = index.where("member like '%/block.json'")
    path = index.first().archive.removeprefix("file://")
    taken = headers.transform(tar_parts.stored_bytes).first().bytes
    assert 0 < taken * 10 < os.path.getsize(path)
    # Frames of shards are not even opened: ruined, they do not matter.
    first_shard = index.where("member like '%/shard_0.json'").agg(F.min("at")).first()[0]
    with open(path, "r+b") as file:
        file.seek(first_shard)
        file.write(b"ruined" * 1000)
    assert contents(tar_parts.read_members(headers)) == {k: v for k, v in want.items() if k.endswith("block.json")}
    with pytest.raises(Exception):
        tar_parts.read_members(index).collect()


def foreign(path, frames, members):
    """An archive of others: the tar stream cut into frames anywhere."""
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as out:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    raw = raw.getvalue()
    step = -(-len(raw) // frames)
    with open(path, "wb") as file:
        for k in range(0, len(raw), step):
            file.write(zstandard.ZstdCompressor().compress(raw[k : k + step]))


@pytest.mark.parametrize("frames", [1, 2, 7, 50])
def test_index_of_foreign_archives(spark, tmp_path, frames):
    members = [(f"d/{h:012d}/block.json", os.urandom(h * 37 % 900)) for h in range(60)] + [("big", os.urandom(70_000)), ("e", b"")]
    foreign(tmp_path / "0-59.tar.zst", frames, members)
    paths = spark.createDataFrame([(str(tmp_path / "0-59.tar.zst"),)], "path string")
    index = tar_parts.index_archives(paths)
    assert index.select("at").distinct().count() <= frames
    assert contents(tar_parts.read_members(index)) == dict(members)


def test_broken_archives_are_reported(spark, tmp_path):
    foreign(tmp_path / "0-9.tar.zst", 4, [("a/b", os.urandom(9000)), ("a/c", os.urandom(9000))])
    foreign(tmp_path / "10-19.tar.zst", 1, [("a/d", b"x"), ("../e", b"y")])
    whole = (tmp_path / "0-9.tar.zst").read_bytes()
    (tmp_path / "20-29.tar.zst").write_bytes(whole[: len(whole) * 2 // 3])
    (tmp_path / "30-39.tar.gz").write_bytes(b"no archive")
    index = tar_parts.index_archives(tar.archive_paths(spark, str(tmp_path))).collect()
    errors = {os.path.basename(r.archive): r.error for r in index if r.error}
    assert set(errors) == {"10-19.tar.zst", "20-29.tar.zst", "30-39.tar.gz"}
    assert errors["10-19.tar.zst"] == "invalid member name"
    assert {r.member for r in index if r.archive.endswith("0-9.tar.zst") and r.member} == {"a/b", "a/c"}
