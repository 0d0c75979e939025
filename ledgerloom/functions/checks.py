"""Predicates, arithmetic and verdicts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import ColumnLike, col

# HTTP status codes an object store answers when a retry can help.
STORE_RETRYABLE = [500, 502, 503]


def whole_div(a: ColumnLike, b: ColumnLike) -> Column:
    """Integer division of two integers."""
    return F.call_function("div", col(a), col(b))


def is_present(size: ColumnLike = "size") -> Column:
    """An object counts as present only if it holds at least one byte."""
    return col(size) > 0


def in_scope(first: ColumnLike, last: ColumnLike, start: int, stop: int | None) -> Column:
    """Range overlaps ``[start, stop]``; no upper bound unless `stop` is positive."""
    hit = col(last) >= start
    return hit & (col(first) <= stop) if stop is not None and stop > 0 else hit


def safe_boundary(latest: ColumnLike, size: int, hot: int) -> Column:
    """Highest multiple of `size` at least `hot` heights behind `latest`, never below 0."""
    latest = col(latest)
    behind = F.greatest(latest - hot if hot > 0 else latest, F.lit(0).cast("bigint"))
    return behind - F.pmod(behind, F.lit(size).cast("bigint")) if size > 0 else behind


def batch_start(height: ColumnLike, start: int, size: int) -> Column:
    """First height of the batch that holds `height`; batches are counted from `start`."""
    height = col(height)
    return height - F.pmod(height - start, F.lit(size).cast("bigint"))


def batch_end(first: ColumnLike, size: int) -> Column:
    """Last height of the batch starting at `first`."""
    return col(first) + (size - 1)


def norm_shard_id(value: Column) -> Column:
    """Text of a shard id held in a VARIANT.

    Integers and strings give their text, JSON null the empty string. Anything else, an
    absent field included, gives null.
    """
    kind = F.schema_of_variant(value)
    return F.when(F.is_variant_null(value), "").when(
        kind.isin("BIGINT", "STRING"), F.try_variant_get(value, "$", "string")
    )


def filled_object(value: ColumnLike) -> Column:
    """A VARIANT holds an object with at least one key."""
    kind = F.schema_of_variant(col(value))
    return F.coalesce(kind.startswith("OBJECT<") & (kind != "OBJECT<>"), F.lit(False))


def valid_payload(text: ColumnLike) -> Column:
    """Payload is a JSON object with at least one key."""
    return filled_object(F.try_parse_json(col(text)))


def classify_status(status: ColumnLike, store: bool) -> Column:
    """``ok``, ``not_found``, ``fallback``, ``retryable`` or ``fatal``.

    An object store is retried on 500, 502 and 503; the HTTP fallback on 429 and from 500 up.
    """
    status = col(status)
    retry = status.isin(STORE_RETRYABLE) if store else (status == 429) | (status >= 500)
    done = F.when(status == 200, "ok").when(status == 404, "not_found")
    if store:
        done = done.when(status == 301, "fallback")
    return done.when(retry, "retryable").otherwise("fatal")


def cap_bps(bytes_per_second: ColumnLike, megabits: ColumnLike) -> Column:
    """Throughput cap in bytes per second; 0 means no cap."""
    rate, mbit = col(bytes_per_second), col(megabits)
    return (
        F.when(rate > 0, rate.cast("bigint"))
        .when(mbit > 0, F.floor(mbit.cast("double") * 1e6 / 8.0).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def megabytes(size: ColumnLike) -> Column:
    """Whole mebibytes."""
    return F.shiftright(col(size), 20)


def reduction_pct(uncompressed: ColumnLike, compressed: ColumnLike) -> Column:
    """Share of bytes saved, in percent; 0 for empty input."""
    u, c = col(uncompressed).cast("double"), col(compressed).cast("double")
    return F.when(u > 0, F.lit(100.0) * (F.lit(1.0) - c / u)).otherwise(F.lit(0.0))


def content_md5(content: ColumnLike) -> Column:
    """Lower-case hex MD5 of the bytes."""
    return F.md5(col(content))
