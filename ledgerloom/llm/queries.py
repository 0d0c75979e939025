"""One query per operator, over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroid_tree,
    fingerprints,
    jaccard_join,
    license_scan,
    line_dedup,
    mixture_packing,
    personal_data,
    sentence_pieces,
    small_world,
    token_counts,
    token_files,
    weak_labels,
    whitening,
)
from .common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 4096
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query("op2_sentencepiece")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.digests(table(spark, folder, "documents"), PIECES)


@query("op7_token_counts")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.prefix_counts(table(spark, folder, "documents"), PIECES, TOKEN_LIMIT)
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counts.select("doc_id", "n_bytes", "n_tokens", over, "chars_within")


@query("op6_personal_data")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin(*personal_data.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, personal_data.BASE),
        F.sha2(personal_data.joined(base), 256).alias("base_sha256"),
        personal_data.joined("spans").alias("spans"),
    )


@query("op3_fingerprints")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, folder, "documents"), WORDS, END_ID))


@query("op10_mixture_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixture_packing.pack(table(spark, folder, "documents"), WORDS, END_ID)


# Spaces and control characters that are stripped from both ends of a line.
STRIPPED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_SQL = f"""
with docs as (
    select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
    select r, doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from docs
), keyed as (
    select *, {LOWERED.format(f"trim(line, {STRIPPED})")} as key from lines
), owners as (
    select key, min(doc_id) as owner from keyed where length(key) >= {line_dedup.SHORTEST_KEY} and doc_id is not null
    group by key having count(distinct doc_id) > 1
), judged as (
    select k.r, k.line, k.place, coalesce(k.doc_id <> o.owner, false) as gone from keyed k left join owners o using (key)
), kept as (
    select r, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
        coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '') as kept
    from judged group by r
)
select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from kept join docs using (r)
"""


@query("op5_line_dedup", LINE_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digests(table(spark, folder, "documents"))


@query("op1_ngram_jaccard")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.jaccard_join(table(spark, folder, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op8_small_world")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return small_world.nearest(table(spark, folder, "embeddings"), k=5, every=50)


@query("op9_weak_labels")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return weak_labels.score(docs, weak_labels.fit(docs, table(spark, folder, "labels")))


@query("op11_centroid_tree", centroid_tree.reference_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_tree.cluster(table(spark, folder, "embeddings"))


@query("op12_license_scan")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, folder, "documents")))


@query("op13_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
