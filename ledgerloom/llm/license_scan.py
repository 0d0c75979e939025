"""License scans: ordered signature rules behind a keyword filter.

A text becomes its words in lower case, parted by single blanks. An Aho-Corasick automaton over
all keywords tells in one pass which rules can match at all; only their patterns run. A detection
goes if one of higher priority contains its words, or one of equal priority that is longer or, of
the same words, from an earlier rule. The phrases of the base are never taken out.

Rows
----
Null and empty texts have no words, no detections and score 0. Null and repeated ids keep their
rows. Texts are scanned whole; patterns have bounded gaps, so time grows with the length of a
text times the rules whose keyword it holds. Extra columns are left out. Empty tables give no
rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, strings, text_columns
from .license_rules import Rule, rules

# What is no part of a word becomes a blank, capitals become small; bytes from 128 on are kept.
_WORDS = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256)
)

SPANS = "array<struct<label: string, first: bigint, last: bigint, score: double, base: boolean>>"
RESULT = f"doc_id bigint, n_words bigint, spans {SPANS}"


def words_of(text: str) -> tuple[bytes, int]:
    """Words parted by blanks, with one at both ends, and their number."""
    found = text.encode("utf-8", "surrogatepass").translate(_WORDS).split(b" ")
    kept = [w for w in found if w]
    return b" " + b" ".join(kept) + b" ", len(kept)


@cache
def _compiled() -> tuple[tuple[Rule, ...], list[re.Pattern], ahocorasick.Automaton]:
    known = rules()
    named: dict[str, list[int]] = {}
    for number, rule in enumerate(known):
        named.setdefault(f" {rule.keyword} ", []).append(number)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in named.items():
        automaton.add_word(keyword, tuple(numbers))
    automaton.make_automaton()
    patterns = [re.compile(rf"(?<= ){rule.pattern}(?= )".encode()) for rule in known]
    return known, patterns, automaton


def detections(words: bytes) -> list[tuple[int, int, int]]:
    """All matches as ``start, end, rule``, by bytes, before suppression."""
    _, patterns, automaton = _compiled()
    # Bytes as characters: every keyword is plain ASCII.
    gated = {tuple_ for _, tuple_ in automaton.iter(words.decode("latin-1"))}
    return [(m.start(), m.end(), n) for numbers in gated for n in numbers for m in patterns[n].finditer(words)]


def resolved(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections that no stronger one contains, and all of the base, in order of place."""
    known = rules()
    kept = []
    # Intervals of all stronger priorities: starts, and the furthest end up to each.
    starts: list[int] = []
    reach: list[int] = []
    every: list[tuple[int, int]] = []
    for priority in sorted({known[n].priority for _, _, n in found}, reverse=True):
        level = sorted((s, -e, n) for s, e, n in found if known[n].priority == priority)
        furthest = -1
        for start, end, number in level:
            end = -end
            place = bisect_right(starts, start) - 1
            inside = end <= furthest or (place >= 0 and reach[place] >= end)
            if known[number].base or not inside:
                kept.append((start, end, number))
            furthest = max(furthest, end)
        every = sorted(every + [(s, -e) for s, e, _ in level])
        starts, reach, furthest = [], [], -1
        for start, end in every:
            furthest = max(furthest, end)
            starts.append(start)
            reach.append(furthest)
    return sorted(kept)


def scanned(text: str) -> tuple[int, list[tuple[str, int, int, float, bool]]]:
    """Number of words and ``label, first word, last word, score, base`` of the detections kept."""
    words, count = words_of(text)
    known = rules()
    out = []
    at = index = 0
    for start, end, number in resolved(detections(words)):
        index += words.count(b" ", at, start)
        at = start
        rule = known[number]
        out.append((rule.label, index - 1, index - 1 + words.count(b" ", start, end), rule.score, rule.base))
    return count, out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words and license detections of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(
            pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])
        )
        for part in slices(batches, "text"):
            found = [scanned(t) for t in strings(part, "text")]
            spans = [[dict(zip(("label", "first", "last", "score", "base"), s)) for s in kept] for _, kept in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array(spans, kinds)],
                names=["doc_id", "n_words", "spans"],
            )

    return text_columns(docs, id_col, text_col).mapInArrow(run, RESULT)


def _joined(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")


def summary(found: DataFrame) -> DataFrame:
    """One row per scanned text: places of the base, its labels and all labels, and the best score."""
    base = F.filter("spans", lambda s: s.base)
    firsts = F.transform(base, lambda s: s.first)
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s.score)), F.lit(0.0)).alias("score"),
        F.transform("spans", lambda s: F.concat_ws(":", s.label, s["first"].cast("string"), s["last"].cast("string"))).alias("places"),
    )
