"""Vectorised words of many texts at once: numpy over UTF-8 bytes.

ASCII white space separates words in all contracts that use this module, so
bytes are enough and no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
WHITE_TABLE = np.zeros(256, dtype=bool)
WHITE_TABLE[[9, 10, 11, 12, 13, 32]] = True
LOWER_TABLE = np.arange(256, dtype=np.uint8)
LOWER_TABLE[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)                 # odd, so it has an inverse modulo 2^64
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + (64 << 10))
        _POWERS[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
                      for b in (BASE, BASE_INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``, whose last byte is white space."""
    white = WHITE_TABLE[data]
    inside = np.concatenate([[False], ~white])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial of each word's bytes."""
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash per word: a polynomial of its bytes, then mixed."""
    return mixed(word_sums(data, starts, ends))


class SegmentWords:
    """Words of one text that comes in segments; a word cut between segments counts once.

    The polynomial is additive, so an unfinished word is carried as its sum and length.
    """

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.sum, self.length = 0, 0

    def finish(self) -> None:
        if self.length:
            self.parts.append(np.array([self.sum], np.uint64))
            self.sum, self.length = 0, 0

    def add(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int, last: int) -> None:
        """The words (polynomials and places) of the next segment, whose bytes are ``first`` to ``last``."""
        if not len(sums):
            if last > first:                                # white space only
                self.finish()
            return
        if starts[0] != first:
            self.finish()
        head = int(sums[0]) * pow(int(BASE), self.length, 1 << 64) + self.sum & (1 << 64) - 1
        length = self.length + int(ends[0] - starts[0])
        if len(sums) > 1:
            self.parts += [np.array([head], np.uint64), sums[1:-1]]
            head, length = int(sums[-1]), int(ends[-1] - starts[-1])
        self.sum, self.length = head, length
        if ends[-1] != last:
            self.finish()

    def hashes(self) -> np.ndarray:
        """The hashes of all words, after the last segment."""
        self.finish()
        return mixed(np.concatenate(self.parts)) if self.parts else np.zeros(0, np.uint64)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text, null as empty."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def cut(text: bytes, limit: int) -> Iterator[bytes]:
    """Segments of about ``limit`` bytes that end at white space (a longer word is cut, see ``SegmentWords``)."""
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(c, at, at + limit) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) + 1
        end = end if end > at else at + limit
        yield text[at:end]
        at = end
    yield text[at:]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, first byte of each, data) of about ``limit`` bytes: whole texts, or
    segments of a longer one.  A line break ends every piece."""
    rows, parts, size = [], [], 0

    def done():
        lengths = np.array([len(p) + 1 for p in parts])
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        return np.array(rows), np.cumsum(lengths) - lengths, data
    for row, text in enumerate(texts):
        for part in cut(text, limit):
            if parts and size + len(part) > limit:
                yield done()
                rows, parts, size = [], [], 0
            rows.append(row)
            parts.append(part)
            size += len(part) + 1
    if parts:
        yield done()
