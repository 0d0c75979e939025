"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import checks, keys
from ..operators import copying, gaps, ranges, stabbing, stats
from ..plans import jobs
from ..schemas import BATCH_STATS, CONTROL
from ..session import configure, materialise, scratch_path
from ..sinks import archives as tar_sink
from ..sinks import batches as sink
from ..sinks import records
from ..sinks.versions import VersionedTable
from ..sources import inventory, payloads, tar, tar_parts
from ..streaming import sealing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START, SIZE, HOT = 0, 1000, 100
RANGE = fx.ARCHIVE_HEIGHTS


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def domain(spark: SparkSession, d: str) -> DataFrame:
    return inventory.height_domain(spark, *inventory.height_bounds(fx.block(spark, d)))


def expected(spark: SparkSession, d: str, size: int | None = None) -> DataFrame:
    """Ranges from 0 to the highest height."""
    return inventory.expected_batches(spark, START, inventory.height_bounds(fx.block(spark, d))[1], size or RANGE)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return keys.parse_archives(fx.archives(spark, d), "archives")


def no_block(spark: SparkSession, d: str) -> DataFrame:
    return gaps.missing_in_range(fx.block_objects(spark, d), *inventory.height_bounds(fx.block(spark, d)))


def all_expected(spark: SparkSession, d: str) -> DataFrame:
    return payloads.distinct_shards(fx.shard(spark, d))


def primary(spark: SparkSession, d: str) -> DataFrame:
    """Blocks, and the shards of the first source of each height."""
    shards = gaps.first_source(fx.sources(spark, d)).select("height", "member", "size")
    return fx.block_objects(spark, d).unionByName(shards)


def fallback(spark: SparkSession, d: str) -> DataFrame:
    """Fallback shards, with a block for each height it knows."""
    shards = fx.fallback(spark, d).select("height", "member", "size")
    blocks = shards.select("height").distinct().select(
        "height", F.lit("block.json").alias("member"), F.lit(7).cast("bigint").alias("size")
    )
    return shards.unionByName(blocks)


def stored_primary(spark: SparkSession, d: str) -> DataFrame:
    """:func:`primary` as a written inventory, as every audit reads it several times."""
    return materialise(primary(spark, d), "primary")


def lost(spark: SparkSession, d: str, have: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Missing heights and missing shards of an inventory."""
    bounds = inventory.height_bounds(fx.block(spark, d))
    return gaps.missing_in_range(have, *bounds), gaps.missing_shards(all_expected(spark, d), have)


def wanted(spark: SparkSession, d: str, have: DataFrame) -> DataFrame:
    return materialise(gaps.refetch_set(*lost(spark, d, have)), "wanted")


def filled(spark: SparkSession, d: str) -> DataFrame:
    have = stored_primary(spark, d)
    return gaps.fill_gaps(have, fallback(spark, d), wanted(spark, d, have))


# --- sources


@query
def scan_inventory(spark, d):
    path = scratch_path(spark, "inventory")
    listed = fx.objects(spark, d).select("key", "size").unionByName(fx.archives(spark, d))
    listed.write.parquet(path)
    return inventory.scan_inventory(spark, path, "data/")


@query
def height_domain(spark, d):
    return domain(spark, d)


@query
def expected_batches(spark, d):
    return expected(spark, d, 700)


@query
def read_heights(spark, d):
    return inventory.read_heights(fx.objects(spark, d), no_block(spark, d)).select("height", "member", "size")


@query
def expected_shards(spark, d):
    return payloads.expected_shards(fx.block_payloads(spark, d))


@query
def distinct_shards(spark, d):
    return all_expected(spark, d)


@query
def split_envelope(spark, d):
    return payloads.split_envelope(fx.envelopes(spark, d)).select("height", "member", "size")


def batch_names(spark, d):
    good = expected(spark, d).select(keys.batch_dir("batch_start", "batch_end").alias("name"))
    bad = expected(spark, d).select(
        F.explode(
            F.array(
                F.concat(keys.batch_dir("batch_start", "batch_end"), F.lit("_3")),
                F.concat(F.lit("batch_x_"), F.col("batch_end").cast("string")),
                keys.batch_dir(F.col("batch_end") + 1, "batch_start"),
            )
        ).alias("name")
    )
    return good.unionByName(bad)


@query
def parse_batch_paths(spark, d):
    return inventory.parse_batch_paths(batch_names(spark, d))


@query
def batch_dir(spark, d):
    return expected(spark, d).select("batch_start", "batch_end", keys.batch_dir("batch_start", "batch_end").alias("name"))


def packed(spark, d, folder, codec="zstd"):
    """Whole documents as blocks, packed into tar archives."""
    texts = fx.table(spark, d, "documents").select(
        F.col("doc_id").alias("height"), F.lit("block.json").alias("member"), F.col("text").alias("payload")
    )
    return tar_sink.pack_archives(texts, folder, START, RANGE, codec)


@query
def expand_archives(spark, d):
    folder = scratch_path(spark, "tar")
    manifest = packed(spark, d, folder)
    members = scratch_path(spark, "members")
    tar.expand_archives(manifest).write.parquet(members)
    return tar.readable_members(spark.read.parquet(members)).select("member", "size", F.md5("payload").alias("md5"))


def packed_parts(spark, d):
    """Documents as blocks, their sources as shards, packed into archives of many frames."""
    docs = fx.table(spark, d, "documents")
    members = F.array(
        F.struct(F.lit("block.json").alias("member"), F.col("source").alias("payload")),
        F.struct(F.lit("shard_0.json").alias("member"), F.col("text").alias("payload")),
    )
    rows = docs.select(F.col("doc_id").alias("height"), F.inline(members))
    folder = scratch_path(spark, "parts")
    tar_sink.pack_archives(rows, folder, START, 10 * RANGE, "gzip")
    return folder


@query
def archive_parts(spark, d):
    members = tar_parts.read_members(tar_sink.archive_index(spark, packed_parts(spark, d)))
    return members.select("member", "size", F.md5("payload").alias("md5"))


@query
def archive_headers(spark, d):
    """Headers alone, out of the frames they lie in, by an index made of the archives themselves."""
    paths = tar.archive_paths(spark, packed_parts(spark, d))
    index = materialise(tar_parts.index_archives(paths), "index")
    headers = tar_parts.read_members(index.where(F.col("member").endswith("/block.json")))
    return headers.select("member", F.col("payload").cast("string").alias("header"))


@query
def latest_height(spark, d):
    return inventory.latest_height(fx.heads(spark, d))


def sealed_static(spark, d):
    return sealing.sealed_now(fx.heads(spark, d), START, SIZE, HOT)


@query
def resume_point(spark, d):
    control = sealed_static(spark, d).select(F.col("batch_end").alias("last_processed_number"))
    return inventory.resume_point(control, START)


# --- sinks


def written(spark, d, write, size=None):
    path = scratch_path(spark, "batches")
    write(fx.sources(spark, d), path, START, size or SIZE)
    return path


def per_batch(rows):
    return rows.groupBy("batch_start").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


@query
def compact_batches(spark, d):
    return per_batch(sink.read_batches(spark, written(spark, d, sink.write_batches)))


@query
def write_heights(spark, d):
    return per_batch(sink.read_batches(spark, written(spark, d, sink.write_heights)))


@query
def batch_inventory(spark, d):
    return sink.batch_inventory(spark, written(spark, d, sink.write_batches)).select("key", "batch_start", "batch_end")


@query
def replace_batches(spark, d):
    path = written(spark, d, sink.write_batches, RANGE)
    broken = ranges.assign_batch(no_block(spark, d), START, RANGE).select("batch_start").distinct()
    kept = ranges.assign_batch(fx.sources(spark, d), START, RANGE).where("size > 0")
    repaired = kept.join(broken, "batch_start", "left_semi").drop("batch_start", "batch_end")
    sink.replace_batches(repaired, path, START, RANGE)
    return per_batch(sink.read_batches(spark, path))


@query
def verify_batches(spark, d):
    path = written(spark, d, sink.write_batches)
    return sink.verify_batches(fx.sources(spark, d), path, START, SIZE).select("batch_start", "files", "bytes", "ok")


def tampered(spark, d):
    """What was to be stored, against a table in which some heights were changed, lost or added."""
    path = written(spark, d, sink.write_batches)
    height, size = F.col("height"), F.col("size")
    rows = fx.sources(spark, d).where(height % 101 != 7).withColumn("size", F.when(height % 97 == 3, size + 1).otherwise(size))
    extra = fx.sources(spark, d).where(height % 89 == 5)
    return rows.unionByName(extra.withColumn("height", -height - 1)), path


@query
def damaged_heights(spark, d):
    return sink.find_damage(*tampered(spark, d), START, SIZE)


def versioned(spark, d):
    """A table of archives with two commits: the sources, then the broken batches without empty files."""
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    table.replace(fx.sources(spark, d), START, RANGE)
    broken = ranges.assign_batch(no_block(spark, d), START, RANGE).select("batch_start").distinct()
    table.replace(table.read().where("size > 0").join(broken, "batch_start", "left_semi"))
    return table


@query
def versioned_batches(spark, d):
    return per_batch(versioned(spark, d).read())


@query
def earlier_version(spark, d):
    return per_batch(versioned(spark, d).read(at=1))


def large_blocks(spark, d):
    return fx.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("height"), (F.floor("o_totalprice").cast("bigint") * 1000).alias("size")
    )


@query
def append_stats(spark, d):
    path = scratch_path(spark, "stats")
    lines = records.batch_stats_rows(stats.batch_stats(large_blocks(spark, d), START, SIZE))
    records.append_stats(lines, path)
    return spark.read.schema(BATCH_STATS).json(path).select("batch", "uncompressed_mb", "dirs")


@query
def audit_events(spark, d):
    lost = ranges.assign_batch(no_block(spark, d), START, SIZE)
    absent = ranges.missing_ranges(expected(spark, d), parsed(spark, d))
    path = scratch_path(spark, "events")
    records.append_lines(
        records.audit_events(
            [
                records.gap_events(lost, "gap_found"),
                records.event(
                    absent,
                    "validate_ranges_missing",
                    batch_start=F.col("first"),
                    missing_range=keys.range_name("first", "last"),
                ),
            ]
        ),
        path,
    )
    return spark.read.schema("kind string, batch_start bigint, height bigint, missing_range string").json(path)


@query
def save_progress(spark, d):
    path = scratch_path(spark, "control")
    records.save_progress(sealed_static(spark, d), path)
    return spark.read.schema(CONTROL).parquet(path)


# --- projections and predicates


@query
def height_key(spark, d):
    return fx.block(spark, d).select("height", keys.height_key("height", "data/").alias("key"))


@query
def rel_key(spark, d):
    return fx.objects(spark, d).select("key", keys.rel_key("key", "/data/").alias("rel"))


@query
def archive_key(spark, d):
    return expected(spark, d).select("batch_start", keys.archive_key("batch_start", "batch_end").alias("key"))


@query
def parse_archives(spark, d):
    return parsed(spark, d).select("key", "first", "last", "ext")


@query
def parse_archives_any_prefix(spark, d):
    return keys.parse_archives(fx.archives(spark, d), exact_prefix=False).select("key", "first", "last", "ext")


@query
def codec_of(spark, d):
    return fx.archives(spark, d).select("key", keys.codec_of("key").alias("codec"))


@query
def height_of(spark, d):
    rows = fx.objects(spark, d).select(
        F.explode(
            F.array(
                F.col("key"),
                F.regexp_replace("key", "^data/0", "data/"),
                F.regexp_replace("key", "^data/", "data/0"),
                F.concat(F.lit("000000000007/"), F.col("key")),
            )
        ).alias("key")
    )
    return rows.select("key", keys.height_of("key").alias("height")).where("height is not null")


@query
def present_objects(spark, d):
    return fx.objects(spark, d).where(checks.is_present("size")).select("height", "member", "size")


@query
def scope_filter(spark, d):
    low, high = inventory.height_bounds(fx.block(spark, d))
    stop = fx.block(spark, d).agg(checks.safe_boundary(F.max("height"), SIZE, HOT)).first()[0]
    return ranges.scope_filter(parsed(spark, d), low + RANGE, stop).select("key", "first", "last")


@query
def dest_key(spark, d):
    rows = fx.source_objects(spark, d)
    return rows.select("key", keys.dest_key("key", "archives/", "copied/").alias("dest_key"))


@query
def safe_boundary(spark, d):
    return fx.heads(spark, d).select(
        F.col("height").alias("event_id"), checks.safe_boundary("height", SIZE, HOT).alias("stop_at")
    )


@query
def norm_shard_id(spark, d):
    number = F.col("shard_id").cast("string")
    text = F.when(F.col("shard_id") % 2 == 0, F.concat(F.lit('{"shard_id":"'), number, F.lit('"}')))
    rows = all_expected(spark, d).select(
        "height", text.otherwise(F.concat(F.lit('{"shard_id":'), number, F.lit("}"))).alias("chunk")
    )
    value = F.try_variant_get(F.try_parse_json("chunk"), "$.shard_id", "variant")
    return rows.select("height", checks.norm_shard_id(value).alias("shard_id"))


@query
def shard_member(spark, d):
    return fx.shard(spark, d).select("height", keys.shard_member("shard_id").alias("member"))


@query
def block_url(spark, d):
    base = "https://api.example.org/v0/block/"
    return fx.block(spark, d).select("height", keys.block_url(base, "height", "k 1*~").alias("url"))


@query
def redact_url(spark, d):
    return fx.requests(spark, d).select("event_id", keys.redact_url("url").alias("url"))


@query
def etag_kind(spark, d):
    return fx.dest_objects(spark, d).select("key", keys.etag_kind("etag").alias("kind"))


@query
def classify_status(spark, d):
    return fx.requests(spark, d).select(
        "event_id",
        checks.classify_status("status", store=True).alias("store_class"),
        checks.classify_status("status", store=False).alias("http_class"),
    )


@query
def cap_bps(spark, d):
    rate = F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).otherwise(0)
    return fx.table(spark, d, "documents").select("doc_id", checks.cap_bps(rate, "doc_id").alias("bps"))


@query
def unsafe_members(spark, d):
    path = F.regexp_replace("url", "^https?://[^/]+/", "")
    name = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("../"), path)).otherwise(path)
    return fx.table(spark, d, "pages").select("page_id", keys.unsafe_member(name).alias("unsafe"))


@query
def valid_payload(spark, d):
    props = F.when(F.col("event_id") % 5 == 0, "null").when(F.col("event_id") % 7 == 0, "{}").otherwise(F.col("props"))
    return fx.table(spark, d, "events").select("event_id", checks.valid_payload(props).alias("ok"))


@query
def size_metrics(spark, d):
    rows = large_blocks(spark, d).select(
        "height", F.col("size").alias("uncompressed"), checks.whole_div("size", F.lit(3)).alias("compressed")
    )
    return stats.size_metrics(rows).select("height", "uncompressed_mb", "compressed_mb", "reduction_pct")


@query
def content_md5(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", checks.content_md5("text").alias("md5"))


# --- gaps and repair


@query
def missing_heights(spark, d):
    return no_block(spark, d)


@query
def missing_shards(spark, d):
    have = fx.block_objects(spark, d).unionByName(fx.sources(spark, d).select("height", "member", "size"))
    return gaps.missing_shards(all_expected(spark, d), have)


@query
def empty_runs(spark, d):
    return gaps.empty_runs(no_block(spark, d), *inventory.height_bounds(fx.block(spark, d)))


@query
def stop_height(spark, d):
    runs = gaps.empty_runs(no_block(spark, d), *inventory.height_bounds(fx.block(spark, d)))
    return gaps.stop_height(runs, 2)


@query
def heights_until(spark, d):
    runs = gaps.empty_runs(no_block(spark, d), *inventory.height_bounds(fx.block(spark, d)))
    return gaps.heights_until(domain(spark, d), gaps.stop_height(runs, 2))


@query
def first_source(spark, d):
    won = gaps.first_source(fx.shard_objects(spark, d))
    return won.groupBy("height", "priority").agg(F.count("*").alias("files"), F.sum("size").alias("bytes")).select(
        "height", F.col("priority").cast("bigint").alias("priority"), "files", "bytes"
    )


@query
def union_sources(spark, d):
    one, two = first_and_second(spark, d)
    rows = inventory.union_sources([("first", 1, one), ("second", 2, two)])
    return rows.select("source", F.col("priority").cast("bigint").alias("priority"), "height", "member", "size")


@query
def refetch_set(spark, d):
    return gaps.refetch_set(*lost(spark, d, stored_primary(spark, d)))


@query
def fill_gaps(spark, d):
    return filled(spark, d)


@query
def fallback_missing(spark, d):
    return gaps.fallback_missing(wanted(spark, d, stored_primary(spark, d)), fallback(spark, d))


@query
def repair_gate(spark, d):
    batches = expected(spark, d, 10).select("batch_start")
    have = stored_primary(spark, d)
    still = gaps.still_missing(have, fallback(spark, d), wanted(spark, d, have), all_expected(spark, d))
    return gaps.complete_batches(batches, *still, START, 10)


@query
def problem_report(spark, d):
    report = gaps.problem_report(*lost(spark, d, stored_primary(spark, d)), START, RANGE)
    return report.select("batch_start", "height", F.array_join("missing_shard_ids", ",").alias("missing_shards"))


@query
def problem_counts(spark, d):
    return gaps.batch_gaps(*lost(spark, d, stored_primary(spark, d)), START, RANGE).drop("batch_end")


@query
def fill_totals(spark, d):
    found = ranges.assign_batch(wanted(spark, d, stored_primary(spark, d)), START, SIZE)
    absent = ranges.assign_batch(gaps.fallback_missing(found, fallback(spark, d)), START, SIZE)
    got = inventory.read_heights(found, fallback(spark, d))
    events = records.audit_events(
        [
            records.gap_events(found, "gap_found"),
            records.gap_events(got, "gap_filled"),
            records.gap_events(absent, "fallback_not_found"),
        ]
    )
    return gaps.fill_totals(events).drop("batch_end")


@query
def layout_check(spark, d):
    odd = (F.floor(F.col("height") / 100) % 3 == 0) & (F.col("height") % 2 == 0)
    rows = fx.block_objects(spark, d).select(
        F.concat(F.when(odd, "alt/").otherwise(""), keys.height_key("height", "data"), F.col("member")).alias("key"), "size"
    )
    return gaps.layout_check(inventory.with_heights(rows), START, RANGE).drop("batch_end")


# --- ranges


@query
def missing_ranges(spark, d):
    return ranges.missing_ranges(expected(spark, d), parsed(spark, d))


@query
def pending_batches(spark, d):
    return ranges.pending_batches(expected(spark, d), fx.archives(spark, d))


@query
def first_archive(spark, d):
    return ranges.first_archive(parsed(spark, d))


@query
def duplicate_archives(spark, d):
    return ranges.duplicate_archives(parsed(spark, d))


@query
def ordered_archives(spark, d):
    return ranges.ordered_archives(parsed(spark, d)).select("first", "last", "key")


@query
def top_missing(spark, d):
    return ranges.top_missing(ranges.missing_ranges(expected(spark, d), parsed(spark, d)))


@query
def validation_summary(spark, d):
    wanted_ranges = expected(spark, d)
    return ranges.validation_summary(wanted_ranges, ranges.missing_ranges(wanted_ranges, parsed(spark, d)))


@query
def coverage_gaps(spark, d):
    return ranges.coverage(parsed(spark, d), *inventory.height_bounds(fx.block(spark, d)))


@query
def assign_batch(spark, d):
    return ranges.assign_batch(fx.objects(spark, d).select("height", "member"), START, SIZE)


@query
def archives_of_heights(spark, d):
    """Blocks that do not count, with every archive that holds them; archives nest and overlap here."""
    wide = parsed(spark, d).select(
        "key", "first", (F.col("last") + F.when(F.col("first") % 300 == 0, 250).otherwise(0)).alias("last")
    )
    return stabbing.covering(no_block(spark, d), wide)


@query
def batch_stats(spark, d):
    return stats.batch_stats(fx.objects(spark, d), START, SIZE)


@query
def dir_size(spark, d):
    return stats.dir_size(fx.objects(spark, d))


# --- copies and inventories


def first_and_second(spark, d):
    rows = fx.sources(spark, d)
    return (rows.where(F.col("priority") == p).select("height", "member", "size") for p in (1, 2))


@query
def to_fetch(spark, d):
    return copying.to_fetch(*first_and_second(spark, d))


@query
def fetch_stats(spark, d):
    return stats.fetch_stats(*first_and_second(spark, d))


@query
def copy_plan(spark, d):
    plan = copying.copy_plan(
        fx.source_objects(spark, d), fx.dest_objects(spark, d), "archives/", "copied/", copy_all_under_prefix=True
    )
    return plan.select("key", "dest_key", "size")


@query
def copy_plan_named(spark, d):
    held = fx.archives(spark, d).where(F.col("size") % 3 == 0).select(
        F.regexp_replace("key", "^archives/", "copied/").alias("key"), "size"
    )
    return copying.copy_plan(fx.archives(spark, d), held, "archives", "copied").select("key", "dest_key", "size")


@query
def copy_counters(spark, d):
    source = fx.source_objects(spark, d).select("key", "size").unionByName(fx.archives(spark, d))
    dest = fx.dest_objects(spark, d).select("key", "size").unionByName(
        fx.archives(spark, d).where(F.col("size") % 3 == 0).select(F.regexp_replace("key", "^archives/", "copied/").alias("key"), "size")
    )
    return copying.copy_counters(source, dest, "archives/", "copied/")


@query
def reconcile_copy(spark, d):
    plan = fx.source_objects(spark, d).withColumn("dest_key", keys.dest_key("key", "archives/", "copied/"))
    return copying.reconcile(plan, fx.dest_objects(spark, d))


@query
def verify_content(spark, d):
    rows = fx.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("key"),
        F.when(F.col("doc_id") % 25 == 1, 0).otherwise(F.octet_length("text")).alias("size"),
        F.when(F.col("doc_id") % 33 == 2, F.md5(F.concat("text", F.lit("x")))).otherwise(F.md5("text")).alias("etag"),
        F.col("text").alias("content"),
    )
    return copying.verify_content(rows)


@query
def exists_keys(spark, d):
    wanted_keys = fx.source_objects(spark, d).select(keys.dest_key("key", "archives/", "copied/").alias("key"))
    return copying.exists_keys(wanted_keys, fx.dest_objects(spark, d))


def prefixed(spark, d):
    return fx.source_objects(spark, d).withColumn("prefix", F.substring_index("key", "/", 2))


@query
def inventory_totals(spark, d):
    return stats.inventory_totals(prefixed(spark, d))


@query
def common_prefixes(spark, d):
    return stats.common_prefixes(fx.source_objects(spark, d), "archives/")


@query
def delete_manifest(spark, d):
    return copying.delete_manifest(fx.source_objects(spark, d), "archives/")


# --- streaming


@query
def sealed_batches(spark, d):
    return sealed_static(spark, d)


@query
def late_heights(spark, d):
    late = fx.table(spark, d, "labels").select(F.col("doc_id").alias("height"))
    return sealing.late_heights(late, sealed_static(spark, d), START, SIZE)


# Files of one slice of heads, and of one micro-batch.
SLICE_FILES = 8


def landed(spark, d, folder, parts=range(4), of=4):
    """Heads written to a landing folder slice by slice, in height order, one slice per micro-batch."""
    rows = fx.heads(spark, d)
    low, high = inventory.height_bounds(rows)
    step = (high - low) // of + 1
    for part in parts:
        first = low + part * step
        land(rows.where(F.col("height").between(first, first + step - 1)), folder)
    return spark.readStream.schema("height bigint").option("maxFilesPerTrigger", SLICE_FILES).parquet(folder)


def land(rows, folder):
    rows.repartition(SLICE_FILES, "height").write.mode("append").parquet(folder)


@query
def sealed_batches_stream(spark, d):
    folder = scratch_path(spark, "stream")
    stream = landed(spark, d, f"{folder}/in")
    sealed = sealing.sealed_batches(stream, START, SIZE, HOT)
    sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return spark.read.schema("batch_start bigint, batch_end bigint, dirs bigint").parquet(f"{folder}/out")


@query
def stream_resume(spark, d):
    folder = scratch_path(spark, "stream")
    for parts in ([0, 1], [2], [3]):
        stream = landed(spark, d, f"{folder}/in", parts)
        sealed = sealing.sealed_batches(stream, START, SIZE, HOT)
        sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return spark.read.schema("batch_start bigint, batch_end bigint, dirs bigint").parquet(f"{folder}/out")


@query
def stream_sink(spark, d):
    folder = scratch_path(spark, "stream")
    stream = landed(spark, d, f"{folder}/in")
    writer = sealing.write_sealed(stream, f"{folder}/out", f"{folder}/ck", START, SIZE, HOT)
    sealing.follow_head(writer).awaitTermination()
    rows = spark.read.schema("height bigint, batch_start bigint, batch_end bigint").parquet(f"{folder}/out/batches")
    return rows.groupBy("batch_start").agg(F.count("*").alias("dirs"))


@query
def open_windows(spark, d):
    folder = scratch_path(spark, "stream")
    sealed = sealing.sealed_batches(landed(spark, d, f"{folder}/in"), START, SIZE, HOT)
    sealing.resume(sealed, f"{folder}/out", f"{folder}/ck").awaitTermination()
    return sealing.open_windows(spark, f"{folder}/ck", START, SIZE)


@query
def late_heights_stream(spark, d):
    folder = scratch_path(spark, "stream")
    late = fx.table(spark, d, "labels").select(F.col("doc_id").alias("height"))
    for _ in range(2):  # the same late rows after a restart are no news
        stream = landed(spark, d, f"{folder}/in", range(4) if not _ else ())
        writer = sealing.write_sealed(stream, f"{folder}/out", f"{folder}/ck", START, SIZE, HOT)
        sealing.follow_head(writer).awaitTermination()
        land(late, f"{folder}/in")
    sealing.follow_head(writer).awaitTermination()
    return sealing.read_late(spark, f"{folder}/out").select("height")


@query
def stream_gap_counts(spark, d):
    folder = scratch_path(spark, "stream")
    stream = landed(spark, d, f"{folder}/in")
    counts = sealing.stream_gap_counts(stream, START, SIZE, HOT)
    sealing.resume(counts, f"{folder}/out", f"{folder}/ck").awaitTermination()
    schema = "batch_start bigint, batch_end bigint, seen bigint, missing bigint"
    return spark.read.schema(schema).parquet(f"{folder}/out")


# --- whole jobs


def with_source(df, name, priority):
    return df.select(F.lit(name).alias("source"), F.lit(priority).alias("priority"), "*")


@query
def archive_job(spark, d):
    folder = scratch_path(spark, "archive")
    return jobs.archive_job(
        fx.sources(spark, d),
        fx.archives(spark, d),
        f"{folder}/out",
        start_from=START,
        size=RANGE,
        latest=inventory.latest_height(fx.heads(spark, d)),
        hot=HOT,
        fallback=fx.fallback(spark, d),
        control_path=f"{folder}/control",
        stats_path=f"{folder}/stats",
    )


@query
def stage_job(spark, d):
    one, two = first_and_second(spark, d)
    low, high = inventory.height_bounds(fx.block(spark, d))
    out = scratch_path(spark, "staged")
    return jobs.stage_job(with_source(one, "first", 1), two, out, start_from=low, stop_at=high, size=SIZE)


@query
def fix_gaps_job(spark, d):
    folder = scratch_path(spark, "gaps")
    have = ranges.assign_batch(fx.block_objects(spark, d), START, RANGE).withColumn("parent", F.lit("data"))
    return jobs.fix_gaps_job(
        batch_names(spark, d),
        have,
        fallback(spark, d),
        f"{folder}/out",
        base_url="https://api.example.org/v0/block",
        api_key="K",
        events_path=f"{folder}/events",
    ).drop("batch_end")


@query
def import_job(spark, d):
    folder = scratch_path(spark, "import")
    packed(spark, d, folder)
    jobs.import_job(spark, folder, f"{folder}-table", prefix=None)
    return per_batch(sink.read_batches(spark, f"{folder}-table"))


def with_headers(spark, d, rows):
    """Adds the JSON header to the non-empty blocks among `rows`."""
    payload = fx.block_payloads(spark, d).select(
        "height", F.lit("block.json").alias("member"), F.col("payload").alias("_p")
    )
    header = F.when(
        (F.col("member") == "block.json") & (F.col("size") > 0), F.coalesce(F.col("_p"), F.lit('{"chunks":[]}'))
    )
    return rows.join(payload, ["height", "member"], "left").withColumn("payload", header).drop("_p")


@query
def audit_repair_job(spark, d):
    folder = scratch_path(spark, "audit")
    members = with_headers(spark, d, primary(spark, d)).withColumn("parent", F.lit("data"))
    table = VersionedTable(spark, f"{folder}/batches")
    table.replace(members, START, RANGE)
    summary = jobs.audit_repair_job(
        fx.archives(spark, d),
        table.read(),
        with_headers(spark, d, fallback(spark, d)),
        table,
        base_url="https://api.example.org/v0/block",
        events_path=f"{folder}/events",
    )
    return summary.drop("error")


@query
def validate_job(spark, d):
    stop = inventory.height_bounds(fx.block(spark, d))[1]
    path = scratch_path(spark, "validation")
    return jobs.validate_job(fx.archives(spark, d), start_from=START, stop_at=stop, size=RANGE, stats_path=path)


def copy_of(spark, d, **options):
    """A copy of all objects; of those planned, every seventh never arrives."""
    source, dest = fx.source_objects(spark, d), fx.dest_objects(spark, d)
    number = F.substring_index("key", "/", -1).cast("bigint")
    sent = copying.copy_plan(source.where(number % 7 != 3), dest, "archives/", "copied/", copy_all_under_prefix=True)
    after = dest.unionByName(sent.select(F.col("dest_key").alias("key"), "size", "etag"))
    names = {"source_prefix": "archives/", "dest_prefix": "copied/", "copy_all_under_prefix": True}
    return jobs.copy_job(source, dest, after=after, **names, **options)


@query
def copy_job(spark, d):
    return copy_of(spark, d)


@query
def copy_job_dry_run(spark, d):
    return copy_of(spark, d, dry_run=True)


@query
def pack_job(spark, d):
    folder = scratch_path(spark, "pack")
    texts = fx.table(spark, d, "documents").select(
        F.col("doc_id").alias("height"), F.lit("block.json").alias("member"), F.col("text").alias("payload")
    )
    jobs.pack_job(texts, folder, start_from=START, size=RANGE, stats_path=f"{folder}-stats")
    lines = spark.read.schema(BATCH_STATS).json(f"{folder}-stats")
    timed = (F.col("download_sec") >= 0) & (F.col("compress_sec") > 0) & (F.col("upload_sec") > 0)
    return lines.select("batch", "uncompressed_mb", "dirs", timed.alias("timed"))


@query
def fix_gaps_from_replies(spark, d):
    """Gaps filled from fetched replies, some of which have a shard without an id or no usable block."""
    have = ranges.assign_batch(fx.block_objects(spark, d), START, RANGE).withColumn("parent", F.lit("data"))
    body = (
        F.when(F.col("height") % 3 == 0, F.regexp_replace("body", '"shard_id"', '"id"'))
        .when(F.col("height") % 5 == 0, F.regexp_replace("body", '"block":', '"head":'))
        .otherwise(F.col("body"))
    )
    replies = fx.envelopes(spark, d).where(F.col("height") % 7 != 1).withColumn("body", body)
    return jobs.fix_gaps_job(batch_names(spark, d), have, None, replies=replies).drop("batch_end")


@query
def exists_job(spark, d):
    names = expected(spark, d).select(keys.archive_key("batch_start", "batch_end").alias("key"))
    return jobs.exists_job(names, fx.archives(spark, d))


@query
def purge_plan_job(spark, d):
    return jobs.purge_plan_job(fx.source_objects(spark, d), "archives/")
