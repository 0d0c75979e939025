"""Folders of neighbouring batches, where one folder per batch would be too many small files.

A folder per batch costs a file, its directories and their listing, however few rows the batch has.
A write of more than `FOLDERS` batches puts them into groups of neighbours instead, folders
``range_start=/range_end=``; the files then hold ``batch_start, batch_end`` themselves, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, hadoop_path
from .digests import PARTITION

GROUP = ["range_start", "range_end"]

# Most batches of a write that get a folder each, and groups that more of them are put into.
FOLDERS, GROUPS = 1_000, 250


def group_width(batches: DataFrame) -> int:
    """Heights per group of `batches` (rows or a listing); 0 if each batch has its own folder."""
    many = F.approx_count_distinct(F.struct(*PARTITION))
    count, low, high = batches.agg(many, F.min("batch_start"), F.max("batch_start")).first()
    return 0 if count <= FOLDERS else -(-(high - low + 1) // GROUPS)


def first_of(start: str | Column, width: int | Column) -> Column:
    """First height of the group that holds a batch; groups lie at multiples of their width."""
    start = F.col(start) if isinstance(start, str) else start
    width = width if isinstance(width, Column) else F.lit(width).cast("bigint")
    return start - F.pmod(start, width)


def grouped(df: DataFrame, width: int) -> DataFrame:
    """`df` with the columns of its folders, if batches are in groups of `width` heights."""
    if not width:
        return df
    low = first_of("batch_start", width)
    return df.withColumns({"range_start": low, "range_end": low + (width - 1)})


def folders(width: int) -> list[str]:
    return GROUP if width else PARTITION


def stored_width(spark: SparkSession, path: str) -> int | None:
    """Heights per group of a stored table, 0 if each batch has its own folder, None without a table."""
    if not exists(spark, path):
        return None
    for first in _below(spark, path):
        low = _value(first, "range_start")
        if low is not None:
            for last in _below(spark, first.getPath().toString()):
                return int(_value(last, "range_end")) - int(low) + 1
        if first.getPath().getName().startswith("batch_start="):
            return 0
    return None


def _below(spark: SparkSession, path: str):
    found, store = hadoop_path(spark, path)
    listed = store.listStatusIterator(found)
    while listed.hasNext():
        yield listed.next()


def _value(status, column: str) -> str | None:
    name, _, value = status.getPath().getName().partition("=")
    return value if name == column and value.lstrip("-").isdigit() else None
