"""Small literal inputs, one per rule that must hold."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import checks, keys
from ledgerloom.operators import copying, gaps, ranges, stats
from ledgerloom.sources import inventory, payloads


def values(df, *columns):
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=repr) if len(rows) and len(rows[0]) > 1 else sorted((r[0] for r in rows), key=repr)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def members(spark, rows):
    return spark.createDataFrame(rows, "height bigint, member string, size bigint")


# --- presence


def test_empty_block_or_absent_block_is_missing(spark):
    objects = members(spark, [(1, "block.json", 5), (2, "block.json", 0), (3, "shard_0.json", 9)])
    assert values(gaps.missing_heights(inventory.height_domain(spark, 1, 4), objects)) == [2, 3, 4]


def test_empty_shard_is_missing_and_absent_blocks_are_not_checked(spark):
    objects = members(
        spark,
        [(1, "block.json", 5), (1, "shard_0.json", 0), (1, "shard_1.json", 4), (2, "block.json", 0), (1, "shard_9.json", 1)],
    )
    expected = spark.createDataFrame([(1, "0"), (1, "1"), (1, "2"), (2, "0")], "height bigint, shard_id string")
    assert values(gaps.missing_shards(expected, objects)) == [(1, "0"), (1, "2")]


def test_height_identified_by_archive(spark):
    objects = spark.createDataFrame(
        [(0, 9, 5, "block.json", 1)], "batch_start bigint, batch_end bigint, height bigint, member string, size bigint"
    )
    domain = ranges.batch_heights(spark.createDataFrame([(0, 9), (5, 6)], "batch_start bigint, batch_end bigint"))
    missing = gaps.missing_heights(domain, objects, ("batch_start", "batch_end", "height"))
    assert missing.where("batch_start = 0").count() == 9
    assert values(missing.where("batch_start = 5"), "height") == [5, 6]


# --- names


@pytest.mark.parametrize(
    "path, height",
    [
        ("data/000000000012/block.json", 12),
        ("000000000012/block.json", 12),
        ("data/00000000012/block.json", None),
        ("data/0000000000012/block.json", None),
        ("000000000001/000000000002/block.json", 1),
        ("data/00000000001x/block.json", None),
        ("data/000000000012", None),
        ("data/000000000012\n/block.json", None),
    ],
)
def test_height_of(spark, path, height):
    assert one(spark, keys.height_of(F.lit(path))) == height


def test_with_heights_splits_paths(spark):
    rows = spark.createDataFrame([("a/b/000000000003/shard_x.json", 1), ("README", 2)], "key string, size bigint")
    assert values(inventory.with_heights(rows), "parent", "height", "member") == [("a/b", 3, "shard_x.json")]


def test_padding_never_truncates(spark):
    assert one(spark, keys.height_key(F.lit(1234567890123).cast("bigint"), "data/")) == "data/1234567890123/"
    assert one(spark, keys.height_key(F.lit(9820210).cast("bigint"))) == "000009820210/"


ARCHIVE_KEYS = [
    ("archives/0-99.tar.zst", True),
    ("archives/100-199.TAR.GZ", True),
    ("archives/000200-0299.tar.gz", True),
    ("archives/0-99.tar.zst\n", False),
    ("archives/9-3.tar.gz", False),
    ("archives/99999999999999999999-99999999999999999999.tar.gz", False),
    ("0-99.tar.gz", False),
    ("archives/sub/0-99.tar.zst", False),
    ("Archives/0-99.tar.zst", False),
    ("archives/0-99.tar.bz2", False),
    ("archives//5-6.tar.gz", True),
]


def test_archive_grammar(spark):
    listed = spark.createDataFrame([(k, 1) for k, _ in ARCHIVE_KEYS], "key string, size bigint")
    assert values(keys.parse_archives(listed, "archives/"), "key") == sorted((k for k, ok in ARCHIVE_KEYS if ok), key=repr)
    assert values(keys.parse_archives(listed, ""), "key") == ["0-99.tar.gz"]
    everywhere = keys.parse_archives(listed, exact_prefix=False)
    assert everywhere.count() == 7
    assert values(everywhere.where("key like '%200%'"), "first", "last", "ext") == [(200, 299, "gz")]


@pytest.mark.parametrize("key, codec", [("a.tar.ZST", "zstd"), ("a.tar.gz", "gzip"), ("a.zst", "gzip")])
def test_codec(spark, key, codec):
    assert one(spark, keys.codec_of(F.lit(key))) == codec


@pytest.mark.parametrize(
    "key, prefix, rel",
    [
        ("data/1/x", "data", "1/x"),
        ("data/1/x", "/data/", "1/x"),
        ("database/1", "data", "database/1"),
        ("/1/x", "", "1/x"),
        ("data", "data", ""),
        ("data//1", "data", "1"),
    ],
)
def test_rel_key(spark, key, prefix, rel):
    assert one(spark, keys.rel_key(F.lit(key), prefix)) == rel


@pytest.mark.parametrize(
    "key, source, dest, target",
    [
        ("a/1", "a/", "", "a/1"),
        ("a/1", "a", "b", "b/1"),
        ("a/1", "a/", "b/", "b/1"),
        ("ab/1", "a", "b", "b/ab/1"),
        ("a/", "a", "b", "b"),
        ("x/1", "", "b", "b/x/1"),
    ],
)
def test_dest_key(spark, key, source, dest, target):
    assert one(spark, keys.dest_key(F.lit(key), source, dest)) == target


def test_batch_folders(spark):
    names = ["batch_1_2", "batch_1_2_3", "batch_x_1", "batch_5_4", "batch_-1_4", "other_1_2", "batch_7", "batch_+3_4"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert values(inventory.parse_batch_paths(df)) == [("batch_+3_4", 3, 4), ("batch_1_2", 1, 2)]


def test_archive_and_batch_names(spark):
    assert one(spark, keys.archive_key(F.lit(1), F.lit(9))) == "archives/1-9.tar.zst"
    assert one(spark, keys.archive_key(F.lit(1), F.lit(9), "", "gzip")) == "1-9.tar.gz"
    assert one(spark, keys.batch_dir(F.lit(1), F.lit(9))) == "batch_1_9"
    assert one(spark, keys.shard_member(F.lit(""))) == "shard_.json"


def test_urls(spark):
    base = "https://api.example.org/v0/block"
    assert one(spark, keys.block_url(base, F.lit(123), "key")) == f"{base}/123?apiKey=key"
    assert one(spark, keys.block_url(f" {base}/ ", F.lit(123))) == f"{base}/123"
    assert one(spark, keys.redact_url(F.lit(f"{base}/1?apiKey=a?b"))) == f"{base}/1"


@pytest.mark.parametrize(
    "etag, kind, md5",
    [
        ('"0123456789abcdef0123456789ABCDEF"', "md5", "0123456789abcdef0123456789abcdef"),
        ("0123456789abcdef0123456789abcdef-2", "other", None),
        ("0123456789abcdef0123456789abcde", "other", None),
        ("0123456789abcdef0123456789abcdeg", "other", None),
    ],
)
def test_etags(spark, etag, kind, md5):
    assert one(spark, keys.etag_kind(F.lit(etag))) == kind
    assert one(spark, keys.etag_md5(F.lit(etag))) == md5


@pytest.mark.parametrize("name, unsafe", [("../x", True), ("a..b", True), ("/abs", False), ("./ok", False)])
def test_unsafe_members(spark, name, unsafe):
    assert one(spark, keys.unsafe_member(F.lit(name))) is unsafe


@pytest.mark.parametrize("name, path", [("./ok", "ok"), ("/abs/x", "abs/x"), ("a/b", "a/b")])
def test_member_path(spark, name, path):
    assert one(spark, keys.member_path(F.lit(name))) == path


# --- arithmetic and verdicts


@pytest.mark.parametrize(
    "latest, size, hot, stop",
    [
        (196840534, 1000, 0, 196840000),
        (196840534, 1000, 10000, 196830000),
        (50, 1000, 100, 0),
        (1234, 0, 34, 1200),
        (1234, 100, -5, 1200),
    ],
)
def test_safe_boundary(spark, latest, size, hot, stop):
    assert one(spark, checks.safe_boundary(F.lit(latest).cast("bigint"), size, hot)) == stop


def test_scope(spark):
    df = spark.createDataFrame([(0, 9), (10, 19), (20, 29)], "first bigint, last bigint")
    assert values(ranges.scope_filter(df, 9, 15), "first") == [0, 10]
    assert values(ranges.scope_filter(df, 10, 0), "first") == [10, 20]
    assert values(ranges.scope_filter(df, 10, None), "first") == [10, 20]


def test_batches_are_clamped_and_bins_are_fixed(spark):
    assert values(inventory.expected_batches(spark, 5, 26, 10)) == [(15, 24), (25, 26), (5, 14)]
    heights = spark.createDataFrame([(5,), (14,), (15,), (26,)], "height bigint")
    assert values(ranges.assign_batch(heights, 5, 10)) == [(14, 5, 14), (15, 15, 24), (26, 25, 34), (5, 5, 14)]


@pytest.mark.parametrize(
    "status, store, kind",
    [
        (200, True, "ok"),
        (404, True, "not_found"),
        (301, True, "fallback"),
        (301, False, "fatal"),
        (500, True, "retryable"),
        (504, True, "fatal"),
        (504, False, "retryable"),
        (429, False, "retryable"),
        (429, True, "fatal"),
        (403, True, "fatal"),
    ],
)
def test_status(spark, status, store, kind):
    assert one(spark, checks.classify_status(F.lit(status), store)) == kind


@pytest.mark.parametrize("rate, mbit, cap", [(12, 1.0, 12), (0, 100.0, 12500000), (0, 0.00001, 1), (0, 0.0, 0)])
def test_cap(spark, rate, mbit, cap):
    assert one(spark, checks.cap_bps(F.lit(rate), F.lit(mbit))) == cap


def test_sizes(spark):
    df = spark.createDataFrame([(3 << 20, (1 << 20) - 1), (0, 0)], "uncompressed bigint, compressed bigint")
    rows = values(stats.size_metrics(df), "uncompressed_mb", "compressed_mb", "reduction_pct")
    assert rows[0] == (0, 0, 0.0)
    assert rows[1][:2] == (3, 0) and rows[1][2] == pytest.approx(100 * (1 - ((1 << 20) - 1) / (3 << 20)))


# --- payloads


def test_shard_ids(spark):
    blocks = [
        (1, '{"chunks":[{"shard_id":0},{"shard_id":"1"},{"shard_id":"abc"},{"shard_id":0},{"shard_id":null}]}'),
        (2, '{"a":1}'),
        (3, '{"chunks":null}'),
        (4, '{"chunks":[{"other":1}]}'),
        (5, '{"chunks":[{"shard_id":1.0}]}'),
        (6, "not json"),
        (7, "[1]"),
        (8, '{"chunks":"x"}'),
        (9, '{"chunks":[null]}'),
        (10, '{"chunks":[{"shard_id":true}]}'),
        (11, '{"chunks":[{"shard_id":9007199254740993}]}'),
        (12, '{"chunks":[]}'),
    ]
    df = spark.createDataFrame(blocks, "height bigint, payload string")
    assert values(payloads.expected_shards(df)) == [(1, ""), (1, "0"), (1, "1"), (1, "abc"), (11, "9007199254740993")]
    assert values(payloads.block_problems(df), "height") == [10, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize(
    "text, ok", [("null", False), ("{}", False), ("[1]", False), ("x", False), (None, False), ('{"a":null}', True)]
)
def test_valid_payload(spark, text, ok):
    assert one(spark, checks.valid_payload(F.lit(text).cast("string"))) is ok


def test_envelopes(spark):
    replies = [
        (1, '{"block":{"n":9007199254740993},"shards":[{"shard_id":0,"big":9007199254740993},{"shard_id":"z"}]}'),
        (2, '{"block":{},"shards":[]}'),
        (3, '{"block":null}'),
        (4, '{"block":{"n":1},"shards":[{"x":1}]}'),
        (5, "broken"),
    ]
    df = spark.createDataFrame(replies, "height bigint, body string")
    rows = payloads.split_envelope(df)
    assert values(rows, "height", "member") == [
        (1, "block.json"),
        (1, "shard_0.json"),
        (1, "shard_z.json"),
        (4, "block.json"),
    ]
    assert rows.where("height = 1 and payload like '%9007199254740993%'").count() == 2
    assert values(payloads.envelope_problems(df), "height") == [2, 3, 4, 5]


# --- sources and repair


def test_first_source_takes_whole_folders_and_counts_empty_files(spark):
    rows = [(1, 1, "block.json", 0), (1, 2, "block.json", 5), (1, 2, "shard_0.json", 5), (2, 2, "block.json", 7)]
    df = spark.createDataFrame(rows, "height bigint, priority int, member string, size bigint")
    for check in (False, True):
        assert values(gaps.first_source(df, check)) == [(1, 1, "block.json", 0), (2, 2, "block.json", 7)]


def test_fill_replaces_by_name_and_keeps_the_rest(spark):
    primary = members(spark, [(1, "block.json", 0), (1, "shard_5.json", 3), (2, "block.json", 4)])
    fallback = members(spark, [(1, "block.json", 9), (1, "shard_0.json", 9), (2, "block.json", 9)])
    wanted = spark.createDataFrame([(1,), (7,)], "height bigint")
    assert values(gaps.fill_gaps(primary, fallback, wanted)) == [
        (1, "block.json", 9),
        (1, "shard_0.json", 9),
        (1, "shard_5.json", 3),
        (2, "block.json", 4),
    ]
    assert values(gaps.fallback_missing(wanted, fallback)) == [7]


def test_layout(spark):
    rows = [("a", 1, "block.json", 1), ("b", 2, "block.json", 1), ("b", 3, "block.json", 0), ("a", 11, "block.json", 1)]
    df = spark.createDataFrame(rows, "parent string, height bigint, member string, size bigint")
    assert values(gaps.layout_check(df, 0, 10)) == [(0, 9, 2, None, "inconsistent"), (10, 19, 1, "a", "ok")]


def test_run_across_slice_edges(spark, monkeypatch):
    monkeypatch.setattr("ledgerloom.operators.common.MAX_SLICES", 5)
    heights = [*range(98, 104), 200, *range(290, 451), 499]
    df = spark.createDataFrame([(h,) for h in heights], "height bigint")
    runs = gaps.empty_runs(df, 0, 499)
    assert values(runs) == [(200, 200, 1), (290, 450, 161), (499, 499, 1), (98, 103, 6)]
    assert gaps.stop_height(runs, 6).first()[0] == 103
    assert gaps.stop_height(runs, 162).first()[0] is None
    domain = inventory.height_domain(spark, 0, 499)
    assert gaps.heights_until(domain, gaps.stop_height(runs, 6)).count() == 104
    assert gaps.heights_until(domain, gaps.stop_height(runs, 162)).count() == 500


# --- ranges


def test_ranges_match_exactly(spark):
    archives = spark.createDataFrame(
        [("a/0-9.tar.gz", 0, 9), ("a/0-9.tar.zst", 0, 9), ("a/11-19.tar.gz", 11, 19)], "key string, first bigint, last bigint"
    )
    expected = inventory.expected_batches(spark, 0, 19, 10)
    assert values(ranges.missing_ranges(expected, archives)) == [(10, 19)]
    assert values(ranges.first_archive(archives), "key") == ["a/0-9.tar.gz", "a/11-19.tar.gz"]
    assert values(ranges.duplicate_archives(archives), "key", "copies") == [("a/0-9.tar.gz", 2), ("a/0-9.tar.zst", 2)]
    summary = ranges.validation_summary(expected, ranges.missing_ranges(expected, archives)).first()
    assert tuple(summary) == (2, 1, "10-19")


def test_coverage(spark):
    rows = [(0, 9), (0, 9), (15, 30), (25, 40), (31, 33), (90, 200)]
    archives = spark.createDataFrame(rows, "first bigint, last bigint")
    assert values(ranges.coverage(archives, 5, 100)) == [
        ("gap", 10, 14, 0),
        ("gap", 41, 89, 0),
        ("overlap", 25, 33, 2),
        ("overlap", 5, 9, 2),
    ]
    nothing = archives.where("first > 1000")
    assert values(ranges.coverage(nothing, 5, 100)) == [("gap", 5, 100, 0)]


# --- copies


def test_copy_plan_filters_by_name_unless_told_otherwise(spark):
    source = spark.createDataFrame(
        [("in/0-9.tar.gz", 1), ("in/note.txt", 2), ("in/9-3.tar.zst", 3), ("other/0-9.tar.gz", 4)], "key string, size bigint"
    )
    dest = spark.createDataFrame([("out/0-9.tar.gz",)], "key string")
    assert values(copying.copy_plan(source, dest, "in", "out"), "dest_key") == ["out/9-3.tar.zst"]
    assert values(copying.copy_plan(source, dest, "in", "out", overwrite=True), "dest_key") == ["out/0-9.tar.gz", "out/9-3.tar.zst"]
    everything = copying.copy_plan(source, dest, "in/", "out/", copy_all_under_prefix=True)
    assert values(everything, "dest_key") == ["out/9-3.tar.zst", "out/note.txt"]
    assert tuple(copying.copy_counters(source, dest, "in", "out").first()) == (3, 1, 1, 1)
    assert tuple(copying.copy_counters(source, dest, "in", "out", overwrite=True).first()) == (3, 1, 0, 2)


def test_reconcile_order(spark):
    a, b = "a" * 32, "b" * 32
    source = spark.createDataFrame(
        [("1", 5, a), ("2", 5, a), ("3", 5, a), ("4", 5, f'"{a.upper()}"'), ("5", 5, a)], "dest_key string, size bigint, etag string"
    )
    dest = spark.createDataFrame(
        [("2", 6, b), ("3", 5, b), ("4", 5, a), ("5", 5, f"{b}-2"), ("9", 1, a)], "key string, size bigint, etag string"
    )
    verdicts = [("1", "missing"), ("2", "size_mismatch"), ("3", "md5_mismatch"), ("4", "ok"), ("5", "ok")]
    assert values(copying.reconcile(source, dest)) == verdicts
    assert values(copying.reconcile(source, dest, include_extra=True)) == [*verdicts, ("9", "extra")]


def test_common_prefixes(spark):
    df = spark.createDataFrame([("a/b/1",), ("a/b/2",), ("a/c/d/3",), ("a/4",), ("b/5/6",)], "key string")
    assert values(stats.common_prefixes(df, "a/")) == ["a/b/", "a/c/"]
    assert values(stats.common_prefixes(df, "")) == ["a/", "b/"]


def test_resume_point(spark):
    control = spark.createDataFrame([(99,), (199,)], "last_processed_number bigint")
    assert inventory.resume_point(control, 7).first()[0] == 200
    assert inventory.resume_point(control.where("false"), 7).first()[0] == 7
