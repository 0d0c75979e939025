"""From raw documents to packed token sequences, stage by stage.

Every stage reads what its predecessor kept and returns the columns of ``documents``; the last
returns the pieces of the sequences. Null ids pass all stages, null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard_join, line_dedup, mixture_packing, personal_data, weak_labels
from ledgerloom.llm.common import stored, table, unused
from ledgerloom.session import ship_package, small_batches

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

# The scorer and whole-text packing are no SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """`docs` with ``n_chars`` brought up to date, where there is such a column and a text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    size = F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", size)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of low quality and toxic ones."""
    return weak_labels.keep(docs, weak_labels.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that an earlier document has; a document left without lines stays, empty."""
    ship_package(spark)
    small_batches(spark)
    return _counted(line_dedup.apply(docs, line_dedup.keep_bitmaps(docs)))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that with the smallest id.

    Rows are judged each, so of rows that repeat an id only those go whose own text is near a
    kept one; of equal rows one stays. Rows without an id link with nothing and stay.
    """
    ship_package(spark)
    (row,) = unused(docs, "row")
    # Stored, so that a row has the same number whenever it is read.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered")
    known = numbered.where(F.col("doc_id").isNotNull())
    groups = jaccard_join.jaccard_join(known, words=5, percent=80, id_col=row).select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")
    )
    first = F.min(F.struct("doc_id", row)).alias("_first")
    firsts = known.select("doc_id", row).join(groups, F.col(row) == F.col("_row")).groupBy("_group").agg(first)
    copies = groups.join(firsts, "_group").where(F.col("_row") != F.col(f"_first.{row}")).select(F.col("_row").alias(row))
    return numbered.join(copies, row, "left_anti").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of personal data in its place."""
    ship_package(spark)
    small_batches(spark)
    return _counted(personal_data.mask(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences with the sources in proportion."""
    ship_package(spark)
    small_batches(spark)
    return mixture_packing.pack(docs, TOKENIZER, END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", ngram_jaccard),
    ("personal_data", personal_data_stage),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
