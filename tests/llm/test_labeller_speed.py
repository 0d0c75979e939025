"""Labellers of weak_labels against plain versions, and the words they need not look at."""

import random
import re

from ledgerloom.llm import weak_labels
from ledgerloom.llm.common import WordCache


def plain_style(text):
    words = text.split()
    n, runs, pairs, k = max(len(words), 1), 0, 0, 0
    while k < len(words):
        same = 1
        while k + same < len(words) and words[k + same] == words[k]:
            same += 1
        pairs, runs, k = pairs + same - 1, runs + (same if same > 2 else 0), k + same
    marked = re.findall(r"\w[^\w\s]{2,}(?=\s|$)", text)
    bare = re.findall(r"(?<!\S)[^\w\s]+(?!\S)", text)
    return {"marked": len(marked) / n, "bare": len(bare) / n, "runs": runs / n, "pairs": pairs / n if n >= 10 else 0.0}


def test_style_is_that_of_plain_loops():
    rng = random.Random(7)
    for _ in range(5000):
        text = "".join(rng.choice("aaB_1 .!?-\n\t\x85\xa0é漢😀́\x1c  ") for _ in range(rng.randrange(50)))
        text += "".join(rng.choice(["a ", "b ", "!! ", "a!! "]) * rng.randrange(4) for _ in range(rng.randrange(9)))
        found = weak_labels.style(text)
        assert {k: found[k] for k in ("marked", "bare", "runs", "pairs")} == plain_style(text)


def test_only_words_that_begin_like_a_marked_stem_are_cut(monkeypatch):
    cut, real = [], weak_labels.stems
    monkeypatch.setattr(weak_labels, "stems", lambda w: cut.append(w) or real(w))
    lists = weak_labels.Lists(stems=frozenset(["abcde", "wxyz"]))
    words = {"abcdefg", "abcd", "abcde", "abcx", "wxyzz", "wxyz", "other", "a"}
    hits = sum(not lists.stems.isdisjoint(real(w)) for w in words)
    assert weak_labels.toxic_votes(words, len(words), lists)[2] == (weak_labels.BAD if hits > 1 else weak_labels.ABSTAIN)
    assert set(cut) == {"abcdefg", "abcd", "abcde", "wxyzz", "wxyz"}


def test_scores_count_each_word_with_its_stems():
    weights = {weak_labels.feature_hash(name): pair for name, pair in {"abcdef": (1.0, 0.0), "abcd*": (0.5, 2.0)}.items()}
    fitted = weak_labels.Classifier(weights, (0.0, 0.0), {})
    assert fitted.word_weights(["abcdef", "abcdx", "abcd", ""]) == [(1.5, 2.0), (0.5, 2.0), None, None]
    scores = fitted.scores(["abcdef ABCDEF other", ""], WordCache(fitted.word_weights))
    assert scores[0, 0] > scores[1, 0] == 0.5
