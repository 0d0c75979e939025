"""Chunks and likeness, EM, the scorer, token look-ups and many sources against plain versions."""

import hashlib
import math
import random
import time

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from ledgerloom.llm import fingerprints, mixture_packing, token_files, weak_labels

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- fingerprints, byte by byte


def plain_gear():
    out = []
    for b in range(256):
        x = (b + 1) * 0x9E3779B97F4A7C15 % 2**64
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        out.append(x >> 32)
    return out


GEAR = plain_gear()


def plain_chunks(text):
    """Chunk digests with lengths: one byte after another, stricter before the normal size."""
    data, found, start, state = text.encode(), {}, 0, 0
    for k, byte in enumerate(data):
        state = (2 * state + GEAR[byte]) % 2**32
        size = k + 1 - start
        ends = size >= 12 and state >> (26 if size < 32 else 28) == 0
        if ends or size == 128 or k + 1 == len(data):
            found[xxhash.xxh3_64_intdigest(data[start : k + 1])] = size
            start = k + 1
    return found


def plain_likeness(one, other):
    if not one:
        return float(not other)
    return sum(n for d, n in one.items() if d in other) / sum(one.values())


def test_fingerprints_byte_by_byte(spark):
    rng = random.Random(20)
    words = ["".join(rng.choice("abcdeéß漢 ") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60, 900]))) for _ in range(60)]
    texts += ["", "a" * 5000, texts[3], "x", None]
    rows = [(7 * k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    written = lambda f: ",".join(f"{d:016x}:{n}" for d, n in sorted(f.items()))
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        one, two, three = map(plain_chunks, (text, changed, following))
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (written(one), written(two))
        assert math.isclose(r.near_edited, plain_likeness(one, two)) and math.isclose(r.near_next, plain_likeness(one, three))


# --- the weak-label model, document by document


def plain_estimate(votes, prior_votes, rounds=100):
    """EM over documents instead of patterns; the last labeller has the given labels."""
    n, m = len(votes), len(votes[0])
    gold = [v[-1] != 0 for v in votes]
    bad = [(0.9 if v[-1] == 2 else 0.1) if g else (0.9 if 2 in v else 0.1) for v, g in zip(votes, gold)]
    most, rest = (prior_votes + sum(gold)) / 4, n - sum(gold)
    weight = [1.0 if g else min(1.0, most / max(rest, 1)) for g in gold]
    for _ in range(rounds):
        sizes = [sum(w * (1 - b) for w, b in zip(weight, bad)), sum(w * b for w, b in zip(weight, bad))]
        shares = []
        for k in range(m):
            sided = all(v[k] != 1 for v in votes)
            prior = [[0.7, 0.3, 0.0], [0.7, 0.0, 0.3]] if k == m - 1 else [[1, 0, 0], [0.7, 0, 0.3]] if sided else [[0.5, 0.5, 0], [0.4, 0.1, 0.5]]
            strength = [prior_votes, min(prior_votes / 4, sizes[1])]
            table = [[0.0] * 3, [0.0] * 3]
            for vote in range(3):
                seen = [sum(w * p for w, p, v in zip(weight, side, votes) if v[k] == vote) for side in ([1 - b for b in bad], bad)]
                for c in (0, 1):
                    table[c][vote] = (seen[c] + strength[c] * prior[c][vote] + 1) / (sizes[c] + strength[c] + 3)
            shares.append(table)
        new = []
        for v in votes:
            logs = [math.log((sizes[c] + 1) / (sum(weight) + 2)) + sum(math.log(shares[k][c][v[k]]) for k in range(m)) for c in (0, 1)]
            new.append(1 / (1 + math.exp(logs[0] - logs[1])))
        moved, bad = max(abs(a - b) for a, b in zip(new, bad)), new
        if moved < 1e-9:
            break
    return bad


def test_estimates_document_by_document():
    rng = random.Random(21)
    votes = []
    for _ in range(400):
        junk = rng.random() < 0.25
        votes.append([2 if rng.random() < (0.7 if junk else 0.05) else 0, rng.choice([0, 1]) if not junk else rng.choice([0, 2]), (2 if junk else 1) if rng.random() < 0.3 else 0])
    counts = {}
    for v in votes:
        counts[weak_labels.packed(v)] = counts.get(weak_labels.packed(v), 0) + 1
    for prior in (10, 1000):
        posteriors, _ = weak_labels.estimate(counts, 3, prior_votes=prior)
        assert all(abs(posteriors[weak_labels.packed(v)] - b) < 1e-6 for v, b in zip(votes, plain_estimate(votes, prior)))


def test_scorer_against_plain_descent():
    """The same minimum as a slow descent over a dense matrix."""
    rng = np.random.default_rng(22)
    x = (rng.random((300, 12)) < 0.3).astype(float)
    targets = np.clip((x[:, 0] + x[:, 1] > 0) * 0.9 + rng.random(300) * 0.1, 0, 1)
    features = np.concatenate([np.flatnonzero(row) + 100 for row in x]).astype(np.int32)
    lengths = x.sum(axis=1).astype(int)
    found, bias = weak_labels.train(features, lengths, targets, rounds=20_000)
    share = targets.mean()
    weights = (targets / share + (1 - targets) / (1 - share)) / 600
    ideal = targets / share / 600 / weights
    pull = x.T @ (weights * (ideal - 0.5))
    x[:, pull <= 1e-3] = 0
    theta, base = np.zeros(12), 0.0
    for _ in range(60_000):
        residual = weights * (1 / (1 + np.exp(-(x @ theta + base))) - ideal)
        theta = np.maximum(theta - 0.3 * (x.T @ residual + 1e-3), 0)
        base -= 0.3 * residual.sum()
    mine = np.array([found.get(100 + k, 0.0) for k in range(12)])
    assert np.abs(mine - theta).max() < 0.02 and abs(bias - base) < 0.02


def test_rare_junk_is_learnt(spark):
    """Beside a common kind of junk, one in 1 of 3,000 documents that no label and no sample shows."""
    rng = random.Random(23)
    parts = [a + b for a in "ka lo mi ne su ra to vi".split() for b in "na re si tu bo da".split()]
    data = [(k, " ".join(rng.sample(parts, 30))) for k in range(15_000)]
    junk = set(range(1500, 15_000, 3000))
    common = set(range(0, 15_000, 20)) - junk
    data = [(k, " ".join(w.upper() for w in t.split()) if k in junk else t) for k, t in data]
    data = [(k, " ".join(w + "!!!" for w in t.split()) if k in common else t) for k, t in data]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    given = spark.createDataFrame([(k, int(k not in common), 0) for k in range(1000)], "doc_id bigint, quality int, toxic int")
    fitted = weak_labels.fit(docs, given, others=500)
    rejected = {r.doc_id for r in weak_labels.score(docs, fitted).where("not keep").collect()}
    assert rejected == junk | common


# --- token files and packing


def test_tokens_are_found_by_place(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    library = Tokenizer.from_file(WORDS)
    texts = ["Some plain words, and more of them. " * k for k in range(12)] + [None, "é漢字"]
    docs = spark.createDataFrame([(3 * k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    ids = {3 * k: [*library.encode(t or "", add_special_tokens=False).ids, 2] for k, t in enumerate(texts)}
    segments = token_files.write(docs, WORDS, 2)
    places = [(d, o) for d, found in ids.items() for o in (-1, 0, len(found) // 2, len(found) - 1, len(found))] + [(5, 0), (None, 0)]
    got = token_files.lookup(segments, spark.createDataFrame(places, "doc_id bigint, offset bigint")).collect()
    want = sorted((d, o, ids[d][o]) for d, o in places if d in ids and 0 <= o < len(ids[d]))
    assert sorted((r.doc_id, r.offset, r.token_id) for r in got) == want


def test_many_sources():
    totals = {f"s{k:04d}": 40_000 + 977 * (k % 61) for k in range(2000)}
    began = time.monotonic()
    mixture = mixture_packing.Mixture(totals)
    counts = [mixture.served(w) for w in (0, 1, mixture.windows // 2, mixture.windows)]
    assert time.monotonic() - began < 5
    for w, served in zip((0, 1, mixture.windows // 2, mixture.windows), counts):
        assert sum(served) == w * mixture_packing.WINDOW // mixture_packing.UNIT
    # One unit after another, the most overdue first, for a few sources.
    small = mixture_packing.Mixture({"a": 64 * 100, "b": 64 * 250, "c": 64 * 33})
    order = sorted((((2 * c + 1) / r), k) for k, r in enumerate(small.rates) for c in range(small.units[k]))
    for w in range(small.windows):
        taken = [k for _, k in order[: 64 * w]]
        assert small.served(w) == [taken.count(k) for k in range(3)]
