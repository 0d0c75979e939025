"""Repeated ids, unusual rows in every stage, and time bounds for very long texts."""

import time

import pytest

import corpus_pipeline
from ledgerloom.llm import personal_data, small_world

A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
B = "some other words that have nothing in common with those of any other text here at all"
LABELS = "/root/testdata/sf0.001"


def test_repeated_ids_lose_no_text(spark):
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]

    def kept(rows):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int")
        return sorted((r.doc_id, r.text) for r in stage(spark, docs, "").collect())

    assert kept([(3, A, 1), (5, B, 1), (5, A, 1), (9, B, 1), (9, B, 1)]) == [(3, A), (5, B)]
    assert kept([(5, A, 1), (5, B, 2), (5, A, 3)]) == [(5, A), (5, B)]


def test_one_of_each_group_stays(spark):
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard"]
    rows = [(7, A, 1), (2, A, 2), (2, A, 3), (4, B, 1), (8, None, 1), (9, "", 1), (9, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row int")
    got = sorted((r.doc_id, r.text or "") for r in stage(spark, docs, "").collect())
    # Texts without words link with nothing, so each of their rows stays.
    assert got == [(2, A), (4, B), (8, ""), (9, ""), (9, "")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_unusual_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, part string, keep int"
    long = " ".join(f"word{i % 977} next{i % 31}" for i in range(30_000)) + "\n" + A
    rows = [
        (1, None, None, None, None, 1, "p", 1), (2, "", "en", "s", 0, 1, "p", 1), (3, A, "en", "s", 80, 1, "p", 1),
        (3, A, "en", "s", 80, 1, "p", 1), (4, long, "en", None, len(long), 1, "p", 1), (None, B, "en", "s", 90, 1, "p", 1),
    ]
    docs = spark.createDataFrame(rows, schema)
    none = stage(spark, docs.limit(0), LABELS)
    got = stage(spark, docs, LABELS)
    assert none.collect() == [] and got.columns == none.columns
    assert name == "packing" or got.columns == docs.columns
    found = [r.doc_id for r in got.collect()]
    assert {1, 2, 3, 4} <= set(found) and (None in found)
    assert name == "packing" or found.count(3) == (1 if name == "ngram_jaccard" else 2)


def test_nearest_of_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [0.0, 1.0]), (9, [0.0, 1.0]), (11, [0.5, 0.5])]
    got = small_world.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), k=5, every=50)
    found = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in got.orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 7, 0.995037), (0, 2, 11, 0.707107), (0, 3, 9, 0.0)]


@pytest.mark.parametrize(
    "part", ["://", "a://", "@", "a@b", "a@b.c@", "1", "1.1.", "1 ", "+1", "password=", "iban ", "account 1", "AKIA", "x://u:p@h/"]
)
def test_long_texts_take_time_in_proportion(part):
    text = part * (1_000_000 // len(part))
    began = time.monotonic()
    personal_data.spans(text)
    assert time.monotonic() - began < 30


def test_long_schemes_are_masked_whole():
    text = "see " + "s" * 30 + "://user:secret@host.example/x now"
    assert personal_data.masked(text) == "see [address] now"
