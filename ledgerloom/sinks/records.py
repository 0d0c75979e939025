"""Statistics, audit events and progress as append-only tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.checks import megabytes, reduction_pct
from ..functions.keys import batch_dir, block_url, padded, range_name, redact_url
from ..schemas import BATCH_STATS, DOWNLOAD_STATS, EVENTS

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# The nine kinds of audit events.
KINDS = [
    "gap_found",
    "gap_filled",
    "gap_fill_failed",
    "archive_problem",
    "archive_repaired",
    "archive_repair_failed",
    "fallback_not_found",
    "archive_repair_skipped_incomplete",
    "validate_ranges_missing",
]


def _as(df: DataFrame, schema: StructType, **columns: Column) -> DataFrame:
    """`df` in a fixed schema, with `columns` computed and absent fields null."""

    def field(f: StructField) -> Column:
        if f.name in columns:
            return columns[f.name].cast(f.dataType).alias(f.name)
        return (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*(field(f) for f in schema))


def batch_stats_rows(stats: DataFrame, stored: str | None = None, run_sec: float | None = None) -> DataFrame:
    """Statistics lines of archived batches out of ``batch_start, batch_end, dirs, bytes``.

    `stored` names the column with the bytes on disk, if known.
    """
    columns = {
        "batch": range_name("batch_start", "batch_end"),
        "uncompressed_mb": megabytes("bytes"),
        "run_sec": F.lit(run_sec),
    }
    if stored:
        columns["compressed_mb"] = megabytes(stored)
        columns["reduction_pct"] = reduction_pct("bytes", stored)
    return _as(stats, BATCH_STATS, **columns)


def download_stats_rows(stats: DataFrame, root: str, run_sec: float | None = None) -> DataFrame:
    """Statistics lines of staged batches."""
    folder = F.concat(F.lit(root.rstrip("/") + "/"), batch_dir("batch_start", "batch_end"))
    return _as(
        stats,
        DOWNLOAD_STATS,
        kind=F.lit("download_batch"),
        batch=range_name("batch_start", "batch_end"),
        local_dir=folder,
        uncompressed_mb=megabytes("bytes"),
        dirs_downloaded=F.col("dirs"),
        run_sec=F.lit(run_sec),
    )


def append_lines(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; null fields are left out."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


append_stats = append_lines


def event(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """Rows of `df` as audit events of one kind. Columns named like event fields are kept."""
    if kind not in KINDS:
        raise ValueError(f"unknown event kind {kind!r}")
    fields = {f.name: f.dataType for f in EVENTS}
    kept = [c for c in df.columns if c in fields and c not in columns]
    return df.select(
        F.lit(kind).alias("kind"),
        F.date_format(F.current_timestamp(), RFC3339).alias("generated_at"),
        *(F.col(c).cast(fields[c]).alias(c) for c in kept if c not in ("kind", "generated_at")),
        *(c.cast(fields[name]).alias(name) for name, c in columns.items()),
    )


def audit_events(parts: list[DataFrame]) -> DataFrame:
    """Events of several kinds in one schema."""
    return _as(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), EVENTS)


def gap_events(missing: DataFrame, kind: str, base_url: str | None = None, api_key: str = "", **columns: Column) -> DataFrame:
    """Events of missing heights (``height, batch_start, batch_end``); URLs lose their query."""
    extra = dict(columns)
    extra["batch"] = batch_dir("batch_start", "batch_end")
    parent = F.nullif(F.col("parent"), F.lit("")) if "parent" in missing.columns else F.lit(None).cast("string")
    extra["dest_dir"] = F.concat_ws("/", extra["batch"], parent, padded("height"))
    if base_url:
        extra["fallback_url"] = redact_url(block_url(base_url, "height", api_key))
    return event(missing, kind, **extra)


def save_progress(sealed: DataFrame, path: str) -> None:
    """Append the last height of the sealed batches to the control table."""
    last = sealed.agg(F.max("batch_end").alias("last_processed_number"))
    last.where("last_processed_number is not null").write.mode("append").parquet(path)
