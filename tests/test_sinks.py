"""Written tables, archives and records, read back."""

import io
import json
import os
import tarfile

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import assign_batch
from ledgerloom.session import scratch_path
from ledgerloom.sinks import archives as tar_sink
from ledgerloom.sinks import batches as sink
from ledgerloom.sinks import records
from ledgerloom.sources import inventory, tar


def objects(spark, heights, size=1):
    return spark.createDataFrame([(h, "block.json", size) for h in heights], "height bigint, member string, size bigint")


def test_replacing_one_batch_keeps_the_others(spark):
    path = scratch_path(spark, "t")
    sink.write_batches(objects(spark, range(50)), path, 0, 10)
    before = {f for f in sink.read_batches(spark, path).inputFiles() if "batch_start=20" not in f}
    sink.replace_batches(objects(spark, [20, 21], 9), path, 0, 10)
    stored = sink.read_batches(spark, path)
    assert before == {f for f in stored.inputFiles() if "batch_start=20" not in f}
    assert stored.where("batch_start = 20").agg(F.sum("size")).first()[0] == 18
    assert stored.count() == 42


def test_verify_finds_a_damaged_batch(spark):
    path = scratch_path(spark, "t")
    sink.write_batches(objects(spark, range(50)), path, 0, 10)
    sink.replace_batches(objects(spark, range(30, 40), 2), path, 0, 10)
    verdicts = sink.verify_batches(objects(spark, range(60)), path, 0, 10)
    assert {r.batch_start for r in verdicts.where("not ok").collect()} == {30, 50}


def test_codecs(spark):
    for codec in ("zstd", "gzip"):
        path = scratch_path(spark, "t")
        sink.write_batches(objects(spark, range(5)), path, 0, 10, codec)
        assert all(f".{'gz' if codec == 'gzip' else 'zstd'}.parquet" in f for f in sink.read_batches(spark, path).inputFiles())
    path = scratch_path(spark, "t")
    sink.write_heights(objects(spark, range(5)), path, 0, 10)
    sink.write_heights(objects(spark, range(5, 7)), path, 0, 10, append=True)
    assert sink.read_batches(spark, path).count() == 7


def test_events_leave_out_absent_fields_and_keys(spark):
    path = scratch_path(spark, "events")
    lost = assign_batch(spark.createDataFrame([(12,)], "height bigint"), 0, 10)
    events = records.audit_events(
        [
            records.gap_events(lost, "gap_filled", "https://api.example.org/v0/block/", "secret"),
            records.event(lost, "archive_repaired", archive_key=F.lit("a")),
        ]
    )
    records.append_lines(events, path)
    records.append_lines(events, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == 4
    filled = next(x for x in lines if x["kind"] == "gap_filled")
    filled.pop("generated_at")
    assert filled == {
        "kind": "gap_filled",
        "batch": "batch_10_19",
        "batch_start": 10,
        "batch_end": 19,
        "height": 12,
        "dest_dir": "batch_10_19/000000000012",
        "fallback_url": "https://api.example.org/v0/block/12",
    }
    assert all("dry_run" not in x for x in lines)
    with pytest.raises(ValueError):
        records.event(lost, "something_else")


def test_generated_at_is_utc(spark):
    lost = assign_batch(spark.createDataFrame([(12,)], "height bigint"), 0, 10)
    text = records.event(lost, "gap_found").first().generated_at
    assert len(text) == 20 and text[10] == "T" and text.endswith("Z")


def test_progress_is_read_back(spark):
    path = scratch_path(spark, "control")
    batches = spark.createDataFrame([(0, 9), (10, 19)], "batch_start bigint, batch_end bigint")
    records.save_progress(batches, path)
    records.save_progress(batches.where("false"), path)
    assert inventory.resume_point(spark.read.parquet(path), 0).first()[0] == 20


def make_tar(path, members, codec):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as out:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
            else:
                info.size = len(data)
            out.addfile(info, io.BytesIO(data or b""))
    data = raw.getvalue()
    if codec == "zst":
        half = len(data) // 2
        compress = zstandard.ZstdCompressor().compress
        packed = compress(data[:half]) + compress(data[half:])  # two frames, one stream
    else:
        import gzip

        packed = gzip.compress(data)
    with open(path, "wb") as f:
        f.write(packed)


def test_expanding_archives(spark, tmp_path):
    good = [("000000000001/", None), ("./000000000001/block.json", b"{}"), ("/000000000001/shard_0.json", b"")]
    make_tar(tmp_path / "0-9.tar.zst", good, "zst")
    make_tar(tmp_path / "10-19.TAR.GZ", good, "gz")
    make_tar(tmp_path / "20-29.tar.gz", [("a/x", b"1"), ("a/../b", b"2"), ("a/y", b"3")], "gz")
    (tmp_path / "30-39.tar.zst").write_bytes(b"not zstd")
    (tmp_path / "note.txt").write_bytes(b"x")
    paths = tar.archive_paths(spark, str(tmp_path))
    assert paths.count() == 4
    rows = spark.createDataFrame(tar.expand_archives(paths).collect(), tar.MEMBERS)
    errors = {os.path.basename(r.archive): r.error for r in rows.where("error is not null").collect()}
    assert errors.keys() == {"20-29.tar.gz", "30-39.tar.zst"}
    assert errors["20-29.tar.gz"] == "invalid member name"
    readable = tar.readable_members(rows)
    assert sorted((os.path.basename(r.archive), r.member, r.size, bytes(r.payload)) for r in readable.collect()) == [
        ("0-9.tar.zst", "000000000001/block.json", 2, b"{}"),
        ("0-9.tar.zst", "000000000001/shard_0.json", 0, b""),
        ("10-19.TAR.GZ", "000000000001/block.json", 2, b"{}"),
        ("10-19.TAR.GZ", "000000000001/shard_0.json", 0, b""),
    ]
    names_only = tar.expand_archives(paths, payloads=False)
    assert names_only.where("payload is not null").count() == 0


def test_packed_archives_are_plain_tar_files(spark):
    rows = spark.range(25).select(
        F.col("id").alias("height"), F.lit("block.json").alias("member"), F.concat(F.lit("n"), "id").alias("payload")
    )
    folder = scratch_path(spark, "tar")
    manifest = tar_sink.pack_archives(rows, folder, 0, 10, "gzip")
    assert sorted((r.batch_start, r.batch_end, r.members) for r in manifest.collect()) == [(0, 9, 10), (10, 19, 10), (20, 29, 5)]
    path = manifest.where("batch_start = 20").first().path
    assert path.endswith("/archives/20-29.tar.gz")
    with tarfile.open(path.removeprefix("file://")) as f:
        assert f.getnames() == [f"{h:012d}/block.json" for h in range(20, 25)]
        assert f.extractfile(f.getnames()[0]).read() == b"n20"


def test_scanning_files_and_inventories(spark, tmp_path):
    (tmp_path / "data" / "000000000001").mkdir(parents=True)
    (tmp_path / "data" / "000000000001" / "block.json").write_text("{}")
    (tmp_path / "other.txt").write_text("xyz")
    files = inventory.scan_inventory(spark, str(tmp_path), "data/", "binaryFile")
    assert [tuple(r) for r in files.collect()] == [("data/000000000001/block.json", 2)]
    table = scratch_path(spark, "csv")
    spark.createDataFrame([("data/a", 0), ("x/b", 5)], "key string, size bigint").write.csv(table)
    listed = inventory.scan_inventory(spark, table, "data/", "csv")
    assert [tuple(r) for r in listed.collect()] == [("data/a", 0)]
    assert inventory.scan_inventory(spark, table, format="csv").count() == 2
    columnar = scratch_path(spark, "orc")
    spark.createDataFrame([("data/a", 0, "e")], "key string, size bigint, etag string").write.orc(columnar)
    assert inventory.scan_inventory(spark, columnar, format="orc").columns == ["key", "size"]
