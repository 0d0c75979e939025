"""Block headers and fetched envelopes in JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import filled_object, norm_shard_id
from ..functions.keys import shard_member


def read_headers(blocks: DataFrame, by: Sequence[str] = ("height",)) -> DataFrame:
    """Distinct shard ids of each block as ``ids``, and ``error`` where the header is unusable."""
    chunks = F.try_variant_get("v", "$.chunks", "variant")
    parsed = blocks.select(*by, F.try_parse_json("payload").alias("v")).select(
        *by,
        F.coalesce(F.schema_of_variant("v").startswith("OBJECT<"), F.lit(False)).alias("is_object"),
        (chunks.isNull() | F.is_variant_null(chunks)).alias("no_chunks"),
        F.try_variant_get("v", "$.chunks", "array<variant>").alias("chunks"),
    )
    # Repeats are dropped inside the row, so no shuffle is needed.
    ids = F.array_distinct(
        F.transform("chunks", lambda c: norm_shard_id(F.try_variant_get(c, "$.shard_id", "variant")))
    )
    broken = ~F.col("is_object") | (~F.col("no_chunks") & F.col("chunks").isNull())
    return parsed.select(*by, broken.alias("broken"), ids.alias("ids")).select(
        *by,
        "ids",
        F.when(F.col("broken"), "malformed block header")
        .when(F.exists("ids", lambda i: i.isNull()), "missing or unsupported shard_id")
        .alias("error"),
    )


def shards_of(headers: DataFrame, by: Sequence[str] = ("height",)) -> DataFrame:
    """Readable shard ids of parsed headers, one row each."""
    return headers.select(*by, F.explode("ids").alias("shard_id")).where("shard_id is not null")


def expected_shards(blocks: DataFrame) -> DataFrame:
    """Shard ids each block refers to, without repeats, as ``height, shard_id``.

    `blocks` holds ``height, payload``, one row per block. References that cannot be read
    give no row here and are listed by :func:`block_problems`.
    """
    return shards_of(read_headers(blocks))


def block_problems(blocks: DataFrame) -> DataFrame:
    """Blocks whose header cannot be read, as ``height, error``."""
    return read_headers(blocks).where("error is not null").select("height", "error")


def distinct_shards(expected: DataFrame) -> DataFrame:
    """Expected ``height, shard_id`` pairs without repeats, also across sources."""
    return expected.select("height", "shard_id").dropDuplicates()


def _envelope_members(envelopes: DataFrame) -> DataFrame:
    """Block row and shard rows of each reply; ``member`` is null where a shard has no usable id."""
    reply = F.from_json("body", "block string, shards array<string>")
    parsed = envelopes.select("height", reply.alias("_e"))
    # One pass over the replies: the block and its shards are elements of one array.
    parts = F.concat(
        F.array(F.struct(F.lit(True).alias("is_block"), F.col("_e.block").alias("payload"))),
        F.transform(
            F.coalesce(F.col("_e.shards"), F.array().cast("array<string>")),
            lambda s: F.struct(F.lit(False).alias("is_block"), s.alias("payload")),
        ),
    )
    rows = parsed.select("height", F.explode(parts).alias("_p")).select(
        "height", "_p.is_block", "_p.payload", F.try_parse_json("_p.payload").alias("_v")
    )
    shard_id = norm_shard_id(F.try_variant_get("_v", "$.shard_id", "variant"))
    return rows.select(
        "height",
        F.when(F.col("is_block"), "block.json").otherwise(shard_member(shard_id)).alias("member"),
        "payload",
        F.when(F.col("is_block") & ~filled_object("_v"), "block is not a filled JSON object")
        .when(~F.col("is_block") & shard_id.isNull(), "missing or unsupported shard_id")
        .alias("error"),
    )


def split_envelope(envelopes: DataFrame) -> DataFrame:
    """Members held by fetched replies, as ``height, member, size, payload``.

    `envelopes` holds ``height, body`` with a body of ``{"block": …, "shards": […]}``.
    Replies that :func:`envelope_problems` reports give no rows for the broken parts.
    """
    return (
        _envelope_members(envelopes)
        .where("error is null")
        .select("height", "member", F.octet_length("payload").cast("bigint").alias("size"), "payload")
    )


def envelope_problems(envelopes: DataFrame) -> DataFrame:
    """Replies with an unusable block or shard, as ``height, error``."""
    return _envelope_members(envelopes).where("error is not null").select("height", "error").distinct()
