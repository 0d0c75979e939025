"""The given tables, seen as inventories, sources, archives and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.checks import whole_div
from .functions.keys import height_key, shard_member


# Heights per archive of :func:`archives`.
ARCHIVE_HEIGHTS = 100


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def block(spark: SparkSession, folder: str) -> DataFrame:
    """Block headers: ``height, size``. Every 40th size is 0."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("height"), (F.floor("o_totalprice").cast("bigint") % 40).alias("size")
    )


def shard(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of three stores: ``priority, height, shard_id, size``. Priority 3 is the fallback."""
    lines = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("priority"),
        F.col("l_orderkey").alias("height"),
        F.col("l_linenumber").cast("bigint").alias("shard_id"),
        F.floor("l_extendedprice").cast("bigint").alias("price"),
    )
    return lines.groupBy("priority", "height", "shard_id").agg((F.max("price") % 25).alias("size"))


def shard_objects(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`shard` as objects: ``priority, height, member, size``."""
    return shard(spark, folder).select("priority", "height", shard_member("shard_id").alias("member"), "size")


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """The two ordered sources without the fallback, read in one scan."""
    rows = shard_objects(spark, folder).where(F.col("priority") <= 2)
    return rows.select(F.when(F.col("priority") == 1, "first").otherwise("second").alias("source"), "*")


def fallback(spark: SparkSession, folder: str) -> DataFrame:
    rows = shard_objects(spark, folder).where(F.col("priority") == 3)
    return rows.select(F.lit("fallback").alias("source"), "*")


def block_objects(spark: SparkSession, folder: str) -> DataFrame:
    return block(spark, folder).select("height", F.lit("block.json").alias("member"), "size")


def objects(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks and shards as one inventory: ``key, height, member, size``."""
    rows = block_objects(spark, folder).unionByName(shard_objects(spark, folder).drop("priority"))
    return rows.select(F.concat(height_key("height", "data"), F.col("member")).alias("key"), "height", "member", "size")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archive inventory with gaps, misaligned, repeated, nested and unusable keys."""
    b, size = F.col("b"), ARCHIVE_HEIGHTS
    bins = table(spark, folder, "orders").select(whole_div("o_orderkey", F.lit(size)).alias("b")).distinct()

    def name(prefix: str, low: int, ext) -> object:
        return F.concat(F.lit(prefix), (b * size + low).cast("string"), F.lit("-"), (b * size + (size - 1)).cast("string"), ext)

    zst, gz = F.lit(".tar.zst"), F.lit(".tar.gz")
    either = F.when(b % 2 == 0, ".tar.zst").otherwise(".TAR.GZ")
    variants = F.array_compact(
        F.array(
            F.when((b % 7 != 3) & (b % 11 != 5) & (b % 17 != 8), F.struct(name("archives/", 0, either).alias("key"), (b * 4096).alias("size"))),
            F.when(b % 11 == 5, F.struct(name("archives/", 1, zst).alias("key"), (b * 10).alias("size"))),
            F.when((b % 13 == 6) & (b % 2 == 0), F.struct(name("archives/", 0, gz).alias("key"), (b * 11).alias("size"))),
            F.when(b % 17 == 8, F.struct(name("archives/sub/", 0, zst).alias("key"), (b * 12).alias("size"))),
            F.when(b % 19 == 4, F.struct(name("archives/000", 0, zst).alias("key"), (b * 13).alias("size"))),
        )
    )
    named = bins.select(F.explode(variants).alias("v")).select("v.key", "v.size")
    odd = spark.createDataFrame(
        [
            ("archives/README.txt", 1),
            ("archives/9-3.tar.gz", 2),
            ("archives/99999999999999999999-99999999999999999999.tar.gz", 3),
            ("0-99.tar.gz", 4),
        ],
        "key string, size bigint",
    )
    return named.unionByName(odd)


def source_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Copy source: ``key, size, etag``."""
    return table(spark, folder, "documents").select(
        F.concat(F.lit("archives/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("key"),
        F.col("n_chars").alias("size"),
        F.md5("text").alias("etag"),
    )


def dest_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Copy destination: some keys absent, some with another size, content or ETag kind."""
    doc = F.col("doc_id")
    return (
        table(spark, folder, "documents")
        .where(doc % 10 != 0)
        .select(
            F.concat(F.lit("copied/"), "source", F.lit("/"), doc.cast("string")).alias("key"),
            F.when(doc % 25 == 1, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("size"),
            F.when(doc % 40 == 3, F.concat(F.md5("text"), F.lit("-2")))
            .when(doc % 33 == 2, F.md5(F.concat("text", F.lit("x"))))
            .otherwise(F.md5("text"))
            .alias("etag"),
        )
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request log: ``event_id, status, url``."""
    kind = F.col("event_id") % 6
    status = F.when(kind == 0, 200).when(kind == 1, 404).when(kind == 2, 429).when(kind == 3, 500).when(kind == 4, 503)
    return table(spark, folder, "events").select(
        "event_id",
        status.otherwise(301).alias("status"),
        F.concat(
            F.lit("https://api.example.org/v0/block/"),
            F.col("event_id").cast("string"),
            F.when(F.col("event_id") % 2 == 0, "?apiKey=K").otherwise(""),
        ).alias("url"),
    )


def _shard_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct shard ids per height, as a sorted array: a block's own list of shards."""
    ids = shard(spark, folder).groupBy("height").agg(F.sort_array(F.collect_set("shard_id")).alias("ids"))
    return ids


def block_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Block headers in JSON."""
    header = F.to_json(
        F.struct(F.transform("ids", lambda i: F.struct(i.alias("shard_id"))).alias("chunks"))
    )
    return _shard_ids(spark, folder).select("height", header.alias("payload"))


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Fetched replies in JSON, one per block: ``height, body``."""
    ids = F.coalesce(F.col("ids"), F.array().cast("array<bigint>"))
    body = F.to_json(
        F.struct(
            F.struct("height", "size").alias("block"),
            F.transform(ids, lambda i: F.struct(i.alias("shard_id"))).alias("shards"),
        )
    )
    return block(spark, folder).join(_shard_ids(spark, folder), "height", "left").select("height", body.alias("body"))


def heads(spark: SparkSession, folder: str) -> DataFrame:
    """Observed heads: ``height``."""
    return table(spark, folder, "events").select(F.col("event_id").alias("height"))
