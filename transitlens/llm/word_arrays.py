"""Words of many texts at once, as numpy arrays.

Texts are put into one byte buffer with a space between them; a table of 256
entries says which bytes belong to words. UTF-8 keeps bytes below 0x80 for
ASCII, so classes that treat all other characters alike need no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PIECE = 256 << 10        # bytes hashed at a time; a longer word is a piece of its own

_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

_not_space = np.ones(256, bool)
_not_space[[0x20, *range(0x09, 0x0E)]] = False
_alnum = np.zeros(256, bool)
_alnum[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SPACED, ALNUM = _not_space, _alnum       # words between white space; words of ASCII letters, digits and all beyond

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``buf``: the lower-cased bytes; word i is buf[start[i]:end[i]]; text t has words first[t] to first[t + 1] - 1."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word: a polynomial over random byte values, then scrambled with the length."""
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + PIECE, side="right")))
            a, b = int(self.start[i]), int(self.end[j - 1])
            if b - a >= len(_powers[0]):
                _grow(b - a + 1)
            up, down = _powers
            run = np.empty(b - a + 1, np.uint64)
            run[0] = 0
            np.cumsum(_BYTE[self.buf[a:b]] * up[:b - a], out=run[1:])
            s, e = self.start[i:j] - a, self.end[i:j] - a
            out[i:j] = mix64((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            i = j
        return out


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> None:
    n = max(n, PIECE + 1)
    _powers[0], _powers[1] = _power_table(_BASE, n), _power_table(_BASE_INV, n)


def words(texts: list[bytes], table: np.ndarray = SPACED, lower: bool = True) -> Words:
    """The words of UTF-8 texts, of A-Z lower-cased."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)[:begins[-1]]
    if lower:
        buf = _LOWER[buf]
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[1:] = table[buf]
    inside[1:][begins[1:] - 1] = 0
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return Words(buf, start, end, np.searchsorted(start, begins))


def shingle_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words, in order; order and number of words matter."""
    out = np.zeros(max(len(w) - n + 1, 0), np.uint64)
    for k in range(n):
        out = mix64(out + w[k:k + len(out)] + np.uint64((k + 1) * 0xA0761D6478BD642F % 2**64))
    return out


def utf8(column) -> list[bytes]:
    """An Arrow column of texts as bytes; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def pieces(sizes: list[int], most: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` bytes and at most ``rows`` rows, a row at least."""
    a, held = 0, 0
    for i, n in enumerate(sizes):
        if i > a and (held + n > most or i - a >= rows):
            yield a, i
            a, held = i, 0
        held += n
    if a < len(sizes):
        yield a, len(sizes)
