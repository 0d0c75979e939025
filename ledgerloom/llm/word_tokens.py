"""Token ids of whole texts with a ``tokenizers`` file, each distinct word encoded once.

The vocabulary's normaliser works within words, and its splitter drops white space and never
crosses it, so the ids of a text are those of its words (cut at spaces and newlines) in
order. The library encodes every distinct word; a worker remembers the results. Arrow cuts
the texts and numbers the distinct words of a slice, so Python meets each of these once.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import WordCache

_caches: dict[str, WordCache] = {}


# Letters with or without full stops behind them. The splitter keeps the two apart, none of
# these signs combine under NFC, and each letter's lower case is one letter, whatever its place.
# Other words are taken whole.
_PLAIN = "^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?]*)$"
_SMALL = re.compile(r"[a-zß-öø-ÿ]+")

# Parts of words a worker remembers per generation of its cache.
CACHE_PARTS = 600_000

# Words that the library gets as one text, and words of texts put together at once.
TOGETHER, WORDS = 4096, 1 << 18

# The normaliser and splitter this division of texts is proven for.
NORMALISERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _checked(path: str) -> None:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    split = parts["pre_tokenizer"]["pretokenizers"][0]
    if (
        parts["normalizer"]["normalizers"] != NORMALISERS
        or split["pattern"]["Regex"] != SPLITTER
        or any(" " in t["content"] or "\n" in t["content"] for t in parts["added_tokens"])
    ):
        raise ValueError(f"texts of {path} can't be cut at white space")


def _cache(path: str) -> WordCache:
    """Part of a word to its ids, four bytes each; kept as long as the Python worker lives."""
    if path not in _caches:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        _checked(path)
        library = Tokenizer.from_file(path)

        # The same model for words that its normaliser and splitter leave as they are, many of them
        # in one text: the last token of a word, and no other, carries the suffix.
        bare = Tokenizer.from_file(path)
        bare.normalizer = normalizers.Sequence([])
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        suffix = bare.model.end_of_word_suffix
        last = np.zeros(bare.get_vocab_size(), bool)
        if suffix:
            last[[k for token, k in bare.get_vocab().items() if token.endswith(suffix)]] = True

        def separate(some: list[str]) -> list[bytes]:
            """Ids of words of small letters."""
            ids = np.array(bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(last[ids]) + 1)
            if len(ends) != len(some) or 4 * len(ids) != ends[-1]:
                return [array("I", e.ids).tobytes() for e in bare.encode_batch_fast(some, add_special_tokens=False)]
            raw, cuts = ids.tobytes(), ends.tolist()
            return [raw[low:high] for low, high in zip([0, *cuts], cuts)]

        def encode(fresh: list[str]) -> list[bytes]:
            ids, small, rest = {}, [], []
            for w in fresh:
                (small if _SMALL.fullmatch(w) else rest).append(w)
            for low in range(0, len(small), TOGETHER):
                some = small[low : low + TOGETHER]
                ids.update(zip(some, separate(some), strict=True))
            found = library.encode_batch_fast(rest, add_special_tokens=False)
            ids.update((w, array("I", e.ids).tobytes()) for w, e in zip(rest, found, strict=True))
            return [ids[w] for w in fresh]

        _caches[path] = WordCache(encode, CACHE_PARTS)
    return _caches[path]


def forget() -> None:
    """Drop what this worker remembers, before other work that needs the memory."""
    _caches.clear()


def _distinct(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words, none of which has a blank, and the number of each word among them."""
    coded = words.dictionary_encode()
    # As one text they get to Python several times faster than one by one.
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")
    return joined[0].as_py().split(" "), coded.indices.to_numpy()


def _chosen(pool: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of the given numbers behind one another, of runs of the given sizes, and where each ends."""
    begins, own = np.cumsum(sizes) - sizes, sizes[numbers]
    ends = np.cumsum(own)
    return pool[np.repeat(begins[numbers] - (ends - own), own) + np.arange(own.sum())], ends


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts behind one another, without special tokens, and how many each text has.

    Null counts as empty.
    """
    if not len(texts):
        return np.empty(0, "<u4"), np.empty(0, np.int64)
    # Nothing here makes cycles, and looking for them among so many words takes a quarter of the time.
    collects = gc.isenabled()
    gc.disable()
    try:
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        plain = pc.extract_regex(coded.dictionary, _PLAIN)
        heads = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "head")), coded.dictionary)
        tails = pc.fill_null(pc.struct_field(plain, "tail"), "")
        distinct, numbers = _distinct(pa.concat_arrays([heads, tails]))
        found = _cache(path).values(distinct)
    finally:
        if collects:
            gc.enable()
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    pool = np.frombuffer(b"".join(found), "<u4")
    # A word is its head and its tail.
    pool, ends = _chosen(pool, sizes, numbers.reshape(2, -1).T.ravel())
    sizes, places = np.diff(ends[1::2], prepend=0), coded.indices.to_numpy()
    parts, ends = [], np.zeros(len(places) + 1, np.int64)
    for low in range(0, len(places), WORDS):
        ids, after = _chosen(pool, sizes, places[low : low + WORDS])
        parts.append(ids)
        ends[low + 1 : low + 1 + len(after)] = ends[low] + after
    return np.concatenate(parts), np.diff(ends[lists.offsets.to_numpy()])


def token_bytes(texts: pa.Array | list[str], path: str) -> list[bytes]:
    """Ids of each text without special tokens, as little-endian unsigned 32-bit numbers."""
    ids, sizes = token_ids(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), path)
    raw, cuts = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
    return [raw[low:high] for low, high in zip([0, *cuts], cuts)]
