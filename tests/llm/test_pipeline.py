"""Text queries against their SQL, and the pipeline against brute force of its stages."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from ledgerloom.llm import personal_data
from ledgerloom.llm.queries import ORACLES, QUERIES
from oracle import compare, connect
from test_operators import brute_components, brute_lines, check_sequences

DATA = os.environ.get("TESTDATA_DIR", "/root/testdata") + "/sf0.001"


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, name):
    assert compare(connect(DATA), ORACLES[name], QUERIES[name](spark, DATA)) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and not n.startswith(("op8", "op10", "op13"))])
def test_a_row_per_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, DATA).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "ngram_jaccard", "personal_data", "packing"]

    def step(name, frame):
        out = stages[name](spark, frame, DATA)
        out = spark.createDataFrame(out.collect(), out.schema)
        return out, {r.doc_id: r for r in out.collect()} if name != "packing" else out.collect()

    docs, good = step("quality_classifier", docs)
    assert docs.columns == columns and set(good) < set(before) and all(good[d] == before[d] for d in good)
    docs, lines = step("line_dedup", docs)
    assert docs.columns == columns and set(lines) == set(good)
    want = {r[0]: (r[1] - r[2], r[3]) for r in brute_lines([(d, r.text) for d, r in good.items()])}
    assert all(want[d][1] == __import__("hashlib").sha256(r.text.encode()).hexdigest() for d, r in lines.items())
    assert all(r.n_chars == len(r.text) for r in lines.values())
    docs, single = step("ngram_jaccard", docs)
    assert docs.columns == columns
    assert set(single) == {c for _, _, c in brute_components([(d, r.text) for d, r in lines.items()], 5, 80)}
    docs, masked = step("personal_data", docs)
    assert docs.columns == columns and set(masked) == set(single)
    assert all(r.text == personal_data.masked(single[d].text) for d, r in masked.items())
    _, pieces = step("packing", docs)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4") for d, r in masked.items()}
    assert sum(p.length for p in pieces) == sum(map(len, ids.values()))
    assert all(p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) for p in pieces)
    check_sequences([(p.sequence_id, p.offset, p.length) for p in pieces])
    whole = corpus_pipeline.run(spark, DATA).collect()
    assert {(p.doc_id, p.doc_tokens) for p in whole} == {(p.doc_id, p.doc_tokens) for p in pieces}
