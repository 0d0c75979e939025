"""Ids of texts by way of the distinct heads and tails of their words."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerloom.llm import word_tokens
from ledgerloom.llm.common import WordCache

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n", "x", "Ab. ab! AB ab?! ab", " two  blanks ", "İi ΣΑΣ ÀÖØÞßàöøþÿ ÿ. ÷ ×! K Å", ".,;:!? a. .a a.b",
    "<|endoftext|> w</w> a\r\nb\tc\x0bd", "漢字, 😀! x y", "it's I'LL. 12.5;", "q" * 3000 + ". " + "q" * 3000,
]


def ids_of(texts):
    ids, sizes = word_tokens.token_ids(texts, PATH)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def test_ids_of_an_arrow_column_are_those_of_the_library(monkeypatch):
    monkeypatch.setattr(word_tokens, "WORDS", 3)  # words of a text are put together in many parts
    monkeypatch.setattr(word_tokens, "TOGETHER", 2)
    word_tokens.forget()
    library = Tokenizer.from_file(PATH)
    wanted = [e.ids for e in library.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    column = pa.array(["before", *TEXTS, "after"], pa.string())
    assert ids_of(column.slice(1, len(TEXTS))) == wanted
    assert ids_of(column.slice(1, len(TEXTS))) == wanted  # remembered
    assert [a.tolist() for a in word_tokens.token_ids(column.slice(0, 0), PATH)] == [[], []]


def test_a_head_is_encoded_once_whatever_its_case_and_tail(monkeypatch):
    met = []
    monkeypatch.setitem(word_tokens._caches, PATH, WordCache(lambda fresh: met.extend(fresh) or [b"\1\0\0\0"] * len(fresh)))
    word_tokens.token_ids(pa.array(["Same same. SAME! same?!", "same\nSame: a1."], pa.string()), PATH)
    assert sorted(met) == ["", "!", ".", ":", "?!", "a1.", "same"]


def test_a_cache_gives_values_of_both_generations():
    met = []
    cache = WordCache(lambda fresh: met.extend(fresh) or [w.encode() for w in fresh], 2)
    for words in (["a", "b", "c"], ["d", "a"], ["e", "b" * 100], ["a", "e", "b" * 100], ["d"]):
        assert cache.values(words) == [w.encode() for w in words]
    assert met.count("a") == 1 and met.count("b" * 100) == 2
