"""Centroid clustering, license scans and whitening against brute force."""

import hashlib
import math
import re

import numpy as np
import pytest

from ledgerloom.llm import bidiagonal, centroid_tree, license_rules, license_scan, whitening
from ledgerloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows, parts=3):
    schema = "vec_id bigint, embedding array<float>, label int, cluster int, x string"
    return spark.createDataFrame([(i, v, 1, 7, "k") for i, v in rows], schema).repartition(parts)


def odd_vectors(length, seed, count=120):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.integers(-2, 3, length).astype(float).tolist()) for i in range(count)]
    rows += [(count + i, rows[i % 7][1]) for i in range(60)]  # copies
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1])]
    bad = [None, [], [NAN] * length, [INF] + [0.0] * (length - 1), [None] + [1.0] * (length - 1)]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


def usable(vectors, length=None):
    return [
        (i, v) for i, v in vectors
        if v and all(c is not None and math.isfinite(c) for c in v) and (length is None or len(v) == length)
    ]


# --- centroid clustering


def brute_clusters(rows, k, rounds, salt="3:"):
    ints = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows]
    packed = lambda x: np.array(x, "<i4").tobytes()
    seeds = sorted((hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), packed(x), x) for i, x in ints if i is not None)
    centroids = [x for _, _, x in seeds[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids)) for _, x in ints]

    for _ in range(rounds):
        members = {}
        for (_, x), (_, n) in zip(ints, assign()):
            members.setdefault(n, []).append(x)
        for n, xs in members.items():
            centroids[n] = [sum(c) // len(xs) for c in zip(*xs)]
    near = assign()
    sums = {}
    for d, n in near:
        sums[n] = sums.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, sums[n], sum(sums.values()), digest[n]) for (i, _), (d, n) in zip(ints, near)), key=str
    )


def test_clusters(spark):
    vectors = odd_vectors(64, 1)
    got = centroid_tree.cluster(frame(spark, [*vectors, (77, [1.0] * 63)]))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(usable(vectors, 64), 8, 10)
    few = vectors[:3]
    assert sorted(map(tuple, centroid_tree.cluster(frame(spark, few)).collect()), key=str) == brute_clusters(few, 8, 10)


def test_clusters_of_equal_vectors_and_none(spark):
    same = [(i, [0.5] * 64) for i in range(30)]
    got = centroid_tree.cluster(frame(spark, same)).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and len(got) == 30
    for rows in ([], [(1, None), (2, [1.0])], [(None, [1.0] * 64)]):
        assert centroid_tree.cluster(frame(spark, rows)).collect() == []
    with pytest.raises(Exception, match="has a component of"):
        centroid_tree.cluster(frame(spark, [(1, [2.0**17] * 64)]))


def test_tree_finds_the_nearest_with_ties():
    rng = np.random.default_rng(2)
    for points, dims, spread in ((1, 2, 3), (5, 3, 2), (40, 2, 3), (300, 4, 3), (200, 16, 50)):
        centroids = rng.integers(-spread, spread + 1, (points, dims)).astype(np.int64)
        rows = rng.integers(-spread, spread + 1, (500, dims)).astype(np.int64)
        away = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
        numbers, squares = centroid_tree.VantageTree(centroids).nearest(rows)
        assert (numbers == away.argmin(axis=1)).all() and (squares == away.min(axis=1)).all()


# --- whitening


def brute_whitening(rows, count=4):
    """Per length: list of vectors, eigenvalues and vectors of the covariance."""
    ints = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows]
    out = {}
    for dim in {len(x) for _, x in ints}:
        fit = sorted({x for _, x in ints if len(x) == dim})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        away = np.array(fit, float) - np.array(sums) / n
        values, vectors = np.linalg.eigh(away.T @ away / n)
        keep = [k for k in range(dim - 1, -1, -1) if values[k] > 1e-9 * max(values[-1], 1e-300)][:count] if n > 1 else []
        out[dim] = (n, sums, values.sum(), values[keep], vectors[:, keep])
    return ints, out


def check_whitening(spark, vectors, distinct_values=True):
    got = whitening.whiten(frame(spark, vectors)).collect()
    ints, facts = brute_whitening(usable(vectors))
    want = {}
    for i, x in ints:
        n, sums, trace, values, axes = facts[len(x)]
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        w = (np.array(x) - np.array(sums) / n) @ axes / np.sqrt(values)
        for k in range(len(values)):
            want.setdefault((i, k + 1), []).append((n, deviation, w[k], values[k] / trace))
    assert len(got) == sum(map(len, want.values()))
    assert len({r.identity_error for r in got}) <= 1 and all(0 <= r.identity_error < 1e-9 for r in got)
    for key in want:
        mine = sorted((r.n, r.deviation, abs(r.whitened), r.explained) for r in got if (r.vec_id, r.component) == key)
        theirs = sorted((n, d, abs(w), e) for n, d, w, e in want[key])
        for a, b in zip(mine, theirs, strict=True):
            assert a[:2] == b[:2] and abs(a[3] - b[3]) < 1e-9
            assert not distinct_values or abs(a[2] - b[2]) < 1e-7
    return got


def test_whitening(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.2, 16)
    vectors = [(i, (rng.normal(size=16) * scale).tolist()) for i in range(200)]
    vectors += [(300 + i, vectors[i][1]) for i in range(90)] + [(5, vectors[9][1]), (None, vectors[3][1])]
    vectors += [(1000 + i, v) for i, v in enumerate([None, [], [NAN] * 16, [INF] + [0.0] * 15, [None] + [1.0] * 15])]
    vectors += [(2000 + i, (rng.normal(size=3) * [5, 2, 1]).tolist()) for i in range(20)]  # another length
    got = check_whitening(spark, vectors)
    signs = {(r.vec_id, r.component): r.whitened for r in got if r.vec_id in (0, 300)}
    assert all(signs[0, k] == signs[300, k] for k in (1, 2, 3, 4))


def test_whitening_of_few_equal_and_even_vectors(spark):
    axes = [(2 * k + s, [float(s * 2 - 1) if j == k else 0.0 for j in range(8)]) for k in range(8) for s in (0, 1)]
    check_whitening(spark, axes, distinct_values=False)  # all eigenvalues are the same
    check_whitening(spark, [(1, [1.0, 2.0, 3.0, 4.0, 5.0]), (2, [3.0, 2.0, 1.0, 0.0, 1.0])])
    far = [(i, [30000.0 + (i % 2), 30000.0 - (i % 3), 5.0]) for i in range(6)]  # close together, far out
    assert {r.component for r in check_whitening(spark, far)} == {1, 2}
    for none in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0]), (3, [1.0])]):
        assert whitening.whiten(frame(spark, none)).collect() == []


def test_exact_deviations():
    totals, n = [2**40, -(2**41), 5], 10**6
    x = np.array([[1, 2, 3], [2**20, -(2**20), 7], [-900_000, 3, 1], [2**40, 0, 0]], np.int64)
    want = [sum((n * int(c) - t) ** 2 for c, t in zip(row.tolist(), totals)) for row in x]
    assert whitening._deviations(x, n, totals) == [w if w < 2**63 else None for w in want]


def test_singular_values():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    cases = [
        np.linalg.qr(rng.normal(size=(100, 30)) * np.logspace(0, -7, 30), mode="r"),
        np.linalg.qr(rng.normal(size=(100, 30)) * np.logspace(-7, 0, 30), mode="r"),
        (q * np.r_[[3.0] * 6, np.ones(14)]) @ q.T, np.eye(9) * 4, np.diag([5.0, 4, 0, 0]), np.array([[2.0]]),
    ]
    for a in cases:
        values, vectors, total = bidiagonal.leading(a, 4)
        want = np.linalg.svd(a, compute_uv=False)
        assert np.allclose(values, want[: len(values)], rtol=1e-13, atol=0) and np.isclose(total, (want**2).sum(), rtol=1e-13)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        assert np.abs(a.T @ (a @ vectors) - vectors * values**2).max() < 1e-12 * values[0] ** 2
    assert len(bidiagonal.leading(np.zeros((3, 3)), 4)[0]) == 0


# --- license scans


def brute_licenses(text):
    """Every rule over the whole text, every pair of detections compared."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    joined, known = " " + " ".join(words) + " ", license_rules.rules()
    found = []
    for number, rule in enumerate(known):
        for m in re.finditer(rf"(?<= ){rule.pattern}(?= )", joined):
            first = joined.count(" ", 0, m.start()) - 1
            found.append((first, first + m.group().count(" "), number))
    kept = [
        (a, b, n) for a, b, n in found
        if known[n].base or not any(
            c <= a and b <= d and (known[m].priority, d - c, -m) > (known[n].priority, b - a, -n)
            for c, d, m in found if m != n
        )
    ]
    base = [
        (label, k) for phrase, label in license_rules.BASE.items()
        for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
    ]
    places = sorted(f"{known[n].label}:{a}:{b}" for a, b, n in kept)
    return (
        len(words), len(base), min((k for _, k in base), default=None), max((k for _, k in base), default=None),
        ",".join(sorted({label for label, _ in base})), ",".join(sorted({known[n].label for *_, n in kept})),
        max((known[n].score for *_, n in kept), default=0.0), places,
    )


LICENSED = [
    None, "", "  \n", "no words of that kind",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "either version 3 of the License. GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "SPDX-License-Identifier: LGPL-2.1-or-later / SPDX-License-Identifier: MIT", "CC-BY-SA 4.0, CC BY, cc by nc nd 3.0",
    "ein Haus mit License Apache 2.0", " MIT Licenseé mit license", "GPLv2 gpl v2 LGPL version 2.1 mpl 2",
    "THE SOFTWARE IS FREE: permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "creativecommons.org/licenses/by-nc/4.0/ creative commons attribution-noncommercial 4.0",
    "gnu general public license " * 300, "dedicate this to the public domain", "\x1cCC\x1fBY\x7f", "x" * 200_000 + " mit license",
]


def test_license_rules_hold_their_keywords():
    assert len(license_rules.rules()) > 300
    for rule in license_rules.rules():
        assert re.search(rf"(?<= ){rule.keyword}(?= )", f" {rule.keyword} ")


def test_license_scan(spark):
    rows = [(3 * i, t, "n_words", 1) for i, t in enumerate(LICENSED)] + [(None, LICENSED[4], "a", 1), (12, LICENSED[4], "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_words int").repartition(4)
    got = license_scan.summary(license_scan.scan(docs)).collect()
    mine = sorted(((r.doc_id, *r[1:-1], sorted(r.places)) for r in got), key=str)
    assert mine == sorted(((i, *brute_licenses(t or "")) for i, t, *_ in rows), key=str)
    assert license_scan.scan(docs.where("false")).collect() == []


def test_license_query_on_whole_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op12_license_scan"](spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert (*r[1:-1], sorted(r.places)) == brute_licenses(docs[r.doc_id] or ""), r.doc_id


def test_whitening_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = QUERIES["op13_whitening"](spark, DATA).collect()
    ints, facts = brute_whitening(usable(vectors))
    (n, sums, trace, values, axes), = facts.values()
    assert len(got) == 4 * len(ints) and {r.n for r in got} == {n}
    by_row = {(r.vec_id, r.component): r for r in got}
    for i, x in ints:
        w = (np.array(x) - np.array(sums) / n) @ axes / np.sqrt(values)
        for k in range(4):
            r = by_row[i, k + 1]
            assert abs(abs(r.whitened) - abs(w[k])) < 1e-8 and abs(r.explained * trace / values[k] - 1) < 1e-9
            assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums)) and r.identity_error < 1e-9
