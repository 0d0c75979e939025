"""Merge-type SentencePiece vocabularies: segments, the merge agenda, and decoding."""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import sentencepiece

SPACE = "▁"
# A character class pair between which the given vocabularies never merge; checked on load.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
STOPS = ".,;:!?"


class PieceModel:
    """Pieces and scores of a ``.model`` file whose merges run by score.

    A text is normalised to a marked text: every space becomes U+2581 and one is put in
    front. Merges never cross certain boundaries (before a run of marks, around a newline,
    between letters and full stops), so the text falls into segments that are encoded on
    their own.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.get_piece_size()
        plain = [i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        scores = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in scores.items()}
        self.tails = {p[k:] for p in self.ids for k in range(len(p))}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = lib.unk_id()
        if any(lib.is_unused(i) for i in plain) or not all(lib.is_byte(i) for i in self.byte_ids):
            raise ValueError("the vocabulary needs byte pieces and no unused pieces")
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.ids):
            raise ValueError("pieces must not cross a space or a newline")
        joint = re.compile(f"[{LETTERS}][{STOPS}]|[{STOPS}][{LETTERS}]")
        if any(joint.search(p) for p in self.ids):
            self._segment = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        else:
            self._segment = re.compile(
                f"{SPACE}*[{LETTERS}]+(?=[{STOPS}\n{SPACE}]|$)|[{STOPS}]+(?=[{LETTERS}\n{SPACE}]|$)"
                f"|\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+"
            )
        self._words = re.compile(f"{SPACE}+[^{SPACE}]*")
        self._bytes_of = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self._text_of = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self._silent = {i for i in range(size) if lib.is_control(i)}
        # ASCII bytes are characters of their own; a byte piece of a space is no mark, though.
        self._simple = self._text_of | {self.byte_ids[b]: bytes([b]) for b in range(128) if b != 0x20}
        self.decimals = [str(i) for i in range(size)]

    def words(self, text: str) -> list[str]:
        """The marked text cut before each run of marks; each word goes without its first mark."""
        if not text:
            return []
        if text[0] != " " and "  " not in text and SPACE not in text:
            return text.split(" ")
        return [w[1:] for w in self._words.findall(SPACE + text.replace(" ", SPACE))]

    def segments(self, word: str) -> list[str]:
        """Segments of one of :meth:`words`, with its first mark."""
        return self._segment.findall(SPACE + word)

    def symbols(self, segment: str) -> list[str]:
        """Merge a segment's characters, best score first, then leftmost.

        The agenda holds pairs of neighbours that form a piece. A popped pair counts only if
        its left symbol still stands and the pair still has the length it had when entered.
        """
        ranks, n = self.ranks, len(segment)
        if n == 1:
            return [segment]
        # An entry is one number: rank of the pair, place of its left symbol, length.
        bits = n.bit_length()
        mask = (1 << bits) - 1
        length, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            rank = ranks.get(segment[i : i + 2])
            if rank is not None:
                agenda.append((rank << bits | i) << bits | 2)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            size, i = entry & mask, entry >> bits & mask
            j = after[i]
            if not length[i] or j >= n or length[i] + length[j] != size:
                continue
            length[i], length[j] = size, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                total = size + length[k]
                rank = ranks.get(segment[i : i + total])
                if rank is not None:
                    heappush(agenda, (rank << bits | i) << bits | total)
            h = before[i]
            if h >= 0:
                total = length[h] + size
                rank = ranks.get(segment[h : h + total])
                if rank is not None:
                    heappush(agenda, (rank << bits | h) << bits | total)
        return [segment[i : i + length[i]] for i in range(n) if length[i]]

    def encode_segment(self, segment: str) -> list[int]:
        out = []
        for symbol in self.symbols(segment):
            piece = self.ids.get(symbol)
            if piece is not None:
                out.append(piece)
            else:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def library_segment_ids(self, segments: list[str]) -> list[list[int]]:
        """The library's ids of segments, each set off by a newline, which merges with nothing."""
        if not segments:
            return []
        lead, newline = self.library.encode("\n")[:-1], self.library.encode("\n")[-1]
        plain = [s for s in segments if s != "\n"]
        text = "".join(["\n" + s.replace(SPACE, " ") for s in plain])
        ids = self.library.encode(text, num_threads=1)[len(lead) :]
        cuts = [k for k, i in enumerate(ids) if i == newline]
        if len(cuts) != len(plain):
            raise ValueError("a newline merges with its neighbours")
        found = {s: ids[a + 1 : b] for s, a, b in zip(plain, cuts, [*cuts[1:], len(ids)], strict=True)}
        return [[newline] if s == "\n" else found[s] for s in segments]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, marks as spaces, the first mark gone, bytes as UTF-8."""
        texts, raws = self._text_of, self._bytes_of
        try:  # no character in several bytes, the usual case
            joined = b"".join(map(self._simple.__getitem__, ids))
        except KeyError:
            parts, run, first = [], bytearray(), True
            for i in ids:
                raw = raws.get(i)
                if raw is not None:
                    run += raw
                    continue
                if run:
                    parts.append(_utf8(bytes(run)))
                    run = bytearray()
                if i in self._silent:
                    continue
                parts.append(texts[i] if i in texts else b" \xe2\x81\x87 ")
            if run:
                parts.append(_utf8(bytes(run)))
            joined = b"".join(parts)
            kept = next((i for i in ids if i not in self._silent), None)
            first = kept in texts
            return (joined[1:] if first and joined.startswith(b" ") else joined).decode()
        return (joined[1:] if joined.startswith(b" ") else joined).decode()


def _utf8(raw: bytes) -> bytes:
    """Bytes as UTF-8; each byte that is part of no character becomes U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + size].decode())
                i += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out).encode()


@lru_cache(maxsize=4)
def load(path: str) -> PieceModel:
    return PieceModel(path)
