"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, ``://`` and
identifier cues. A local parser per kind starts at its anchors, expands to both sides and
validates what it found. Parsers go left to right and never give up a span they consumed, so
spans of one kind do not overlap and each text is read a constant number of times.

Kinds, in the order of their spans
----------------------------------
``email, ip, card, phone`` are defined by their patterns alone. The method adds ``account``
(digits or an IBAN after a cue), ``address`` (web address with user data or a numeric host)
and ``credential`` (value after a cue, access key ids).

Rows
----
Null and empty texts have no spans. Repeated rows are searched each; a null id is returned as
it is. Extra columns are left out of :func:`find` and kept by :func:`mask`. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, strings, text_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "address", "credential")
SCHEMA = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"

# Cues in front of account numbers and of credentials, and access key prefixes.
ACCOUNT_CUES = ("iban", "account number", "account no", "account", "acct", "ssn", "passport")
CREDENTIAL_CUES = ("password", "passwd", "pwd", "secret", "api_key", "apikey", "access_token", "auth_token")
KEY_PREFIXES = ("AKIA", "ASIA")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,}(?![A-Za-z0-9])")
_AFTER_CUE = re.compile(r"(?: (?:is|number|no\.?|#))?[ ]?[:=#]?[ ]?")
_SCHEME = re.compile(r"[A-Za-z0-9+.-]")
_ADDRESS = re.compile(r"[^\s<>\"'`]++")
_NUMERIC_HOST = re.compile(r"(?:\[[0-9A-Fa-f:.]+\]|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?=[:/?#]|$)")
_ASSIGNED = re.compile(r"[\"']?\s?[=:]\s?[\"']?")
_VALUE = re.compile(r"[^\s\"',;]{6,}+")
_KEY_ID = re.compile(r"[0-9A-Z]{16}(?![0-9A-Za-z])")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    """ISO 13616 check: the number made of the rearranged letters and digits is 1 modulo 97."""
    flat = text.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for anchor in ("@", "+", "://", *"0123456789"):
        automaton.add_word(anchor, ("digit" if anchor.isdigit() else anchor, len(anchor)))
    for kind, cues in (("account", ACCOUNT_CUES), ("credential", CREDENTIAL_CUES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
                automaton.add_word(form, (kind, len(form)))
    for prefix in KEY_PREFIXES:
        automaton.add_word(prefix, ("key", len(prefix)))
    automaton.make_automaton()
    return automaton


def _email(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    domain = _DOMAIN.match(text, at + 1)
    if not domain:
        return None
    start = at
    while start > free and _LOCAL.match(text[start - 1]):
        start -= 1
    return (start, domain.end(), True) if start < at else None


def _ip(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    if at and text[at - 1] in "0123456789" and at > free:
        return None  # a run of digits starts further left
    found = _DOTTED.match(text, at)
    if not found:
        return None
    parts = [p.lstrip("0") for p in found.groups()]
    return at, found.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _card(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = _CHAIN.match(text, at)
    if not found:
        return None
    digits = found.group().replace(" ", "").replace("-", "")
    return at, found.end(), 13 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    found = _PHONE.match(text, at)
    if not found:
        return None
    end = at + len(found.group().rstrip(" ().-"))
    if end < at + 4:
        return None
    return at, end, 9 <= sum(c.isdigit() for c in text[at:end]) <= 15


def _account(text: str, start: int, end: int, free: int) -> tuple[int, int] | None:
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return None
    begin = _AFTER_CUE.match(text, end).end()
    iban = _IBAN.match(text, begin)
    if iban and iban_ok(iban.group()):
        return begin, iban.end()
    number = _NUMBER.match(text, begin)
    return (begin, number.end()) if number else None


def _address(text: str, at: int, free: int) -> tuple[int, int, bool] | None:
    start = at
    while start > free and _SCHEME.match(text[start - 1]):
        start -= 1
    # Without a scheme nothing is read; what is read is not read again, as it becomes the span.
    rest = _ADDRESS.match(text, at + 3) if start < at else None
    if not rest:
        return None
    body = rest.group().rstrip(".,;:!?)]}")
    host = re.split(r"[/?#]", body, maxsplit=1)[0]
    return start, at + 3 + len(body), "@" in host[1:-1] or bool(_NUMERIC_HOST.match(body))


def _credential(text: str, start: int, end: int, free: int) -> tuple[int, int] | None:
    if start and text[start - 1].isalnum():
        return None
    assigned = _ASSIGNED.match(text, end)
    if not assigned or assigned.end() < free:
        return None  # in a value already found; reading it again for each cue in it would take long
    value = _VALUE.match(text, assigned.end())
    return value.span() if value else None


def _key_id(text: str, start: int, end: int, free: int) -> tuple[int, int] | None:
    found = _KEY_ID.match(text, end)
    return (start, found.end()) if found and not (start and text[start - 1].isalnum()) else None


_BY_PATTERN = {
    "@": (("email", _email),),
    "digit": (("ip", _ip), ("card", _card)),
    "+": (("phone", _phone),),
    "://": (("address", _address),),
}
_BY_CUE = {"account": ("account", _account), "credential": ("credential", _credential), "key": ("credential", _key_id)}


def spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in the order of :data:`KINDS`, then by start."""
    free = dict.fromkeys(KINDS, 0)
    found: dict[str, list[tuple[str, int, int]]] = {kind: [] for kind in KINDS}
    for last, (anchor, size) in _automaton().iter(text):
        at = last - size + 1
        for kind, parse in _BY_PATTERN.get(anchor, ()):
            if at >= free[kind]:
                span = parse(text, at, free[kind])
                if span:
                    free[kind] = span[1]
                    if span[2]:
                        found[kind].append((kind, span[0], span[1]))
        if anchor in _BY_CUE:
            kind, expand = _BY_CUE[anchor]
            span = expand(text, at, last + 1, free[kind])
            if span and span[0] >= free[kind]:
                free[kind] = span[1]
                found[kind].append((kind, *span))
    return [span for kind in KINDS for span in found[kind]]


def masked(text: str) -> str:
    """`text` with each stretch of personal data replaced by the kind that begins it."""
    parts, done = [], 0
    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    parts.append(text[done:])
    return "".join(parts)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every whole text; starts and ends in code points, ends exclusive."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [
                [{"kind": k, "start": a, "end": b} for k, a, b in spans(text)] for text in strings(batch, "text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return text_columns(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with personal data masked in `text_col`; null texts stay null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [None if t is None else masked(t) for t in batch.column(text_col).to_pylist()]
            yield batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def joined(column: str | Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    column = F.col(column) if isinstance(column, str) else column
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
