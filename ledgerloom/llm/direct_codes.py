"""Directly addressable codes: numbers cut into byte chunks on levels.

Level 0 holds the lowest byte of every number, level 1 the next byte of those that have one,
and so on. A bitmap per level but the last says which numbers go on; a rank directory counts
the set bits before every block of the bitmap. The number at any place is found by one chunk
and one rank per level, a run of numbers by one slice per level; nothing else is read.

File
----
``DAC1``, levels (1 byte), then per level its length (8 bytes), then per level: chunks, and
for all but the last the bitmap (padded to whole blocks) and the rank directory (4 bytes per
block). Numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
BLOCK = 64  # bytes of bitmap per entry of the rank directory
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode(numbers: np.ndarray) -> bytes:
    """A file of unsigned numbers below 2**32."""
    rest = np.asarray(numbers, np.uint32)
    lengths, body = [], []
    while True:
        lengths.append(len(rest))
        body.append((rest & np.uint32(255)).astype(np.uint8).tobytes())
        more = rest > 255
        if not more.any():
            break
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % BLOCK))
        ones = _ONES[bitmap].reshape(-1, BLOCK).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4")
        body += [bitmap.tobytes(), ranks.tobytes()]
        rest = rest[more] >> np.uint32(8)
    return b"".join([MAGIC, struct.pack(f"<B{len(lengths)}Q", len(lengths), *lengths), *body])


class DirectCodes:
    """Random access to a file made by :func:`encode`."""

    def __init__(self, data: bytes):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a file of direct codes")
        (levels,) = struct.unpack_from("<B", data, 4)
        lengths = struct.unpack_from(f"<{levels}Q", data, 5)
        at = 5 + 8 * levels
        self._levels = []
        for k, size in enumerate(lengths):
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size
            if k == levels - 1:
                self._levels.append((chunks, None, None))
                break
            blocks = -(-size // (8 * BLOCK))
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK, at)
            at += blocks * BLOCK
            ranks = np.frombuffer(data, "<u4", blocks, at)
            at += 4 * blocks
            self._levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, place: int) -> int:
        """Set bits before `place`."""
        block, byte = place // (8 * BLOCK), place // 8
        if block >= len(ranks):
            return int(ranks[-1]) + int(_ONES[bitmap[-BLOCK:]].sum()) if len(ranks) else 0
        inside = int(_ONES[bitmap[block * BLOCK : byte]].sum())
        return int(ranks[block]) + inside + bin(int(bitmap[byte]) & ((1 << place % 8) - 1)).count("1")

    def at(self, place: int) -> int:
        """The number at `place`."""
        if not 0 <= place < len(self):
            raise IndexError(place)
        value = 0
        for k, (chunks, bitmap, ranks) in enumerate(self._levels):
            value |= int(chunks[place]) << 8 * k
            if bitmap is None or not bitmap[place // 8] >> place % 8 & 1:
                break
            place = self._rank(bitmap, ranks, place)
        return value

    def run(self, start: int, stop: int) -> np.ndarray:
        """The numbers from `start` up to `stop`."""
        start, stop = max(start, 0), min(stop, len(self))
        values = np.zeros(max(stop - start, 0), np.uint32)
        places = np.arange(len(values))
        for k, (chunks, bitmap, ranks) in enumerate(self._levels):
            if not len(places):
                break
            values[places] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * k)
            if bitmap is None:
                break
            bits = np.unpackbits(bitmap[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start]
            places = places[bits.astype(bool)]
            start = self._rank(bitmap, ranks, start)
            stop = start + len(places)
        return values
