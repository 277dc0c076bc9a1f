"""Vectorised words of UTF-8 texts: bounds and 64-bit hashes in numpy.

Words are runs of bytes other than \\x20 and \\x09-\\x0D. A word's hash is a
polynomial over its bytes modulo 2**64 (prefix sums, so one pass over the
text whatever the number of words), then a finaliser with the length.
"""

from __future__ import annotations

import numpy as np

from .common import mix

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C2B  # odd, 3 modulo 8
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = mix(np.arange(256, dtype=np.uint64), 11) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n (at least), kept between calls."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for k, b in ((0, _BASE), (1, _INVERSE)):
                f = np.full(n, np.uint64(b))
                f[0] = 1
                _powers[k] = np.multiply.accumulate(f)
    return _powers[0], _powers[1]


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = sum of value(byte) * base**position over i..j."""
    up, _ = powers(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[data] * up[:len(data)], out=c[1:])
    return c


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    edge = np.flatnonzero(np.diff(inside))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    c = byte_prefix(data)
    _, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        h = (c[end] - c[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def window_hashes(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """One hash for each run of ``k`` consecutive values (order counts)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out *= np.uint64(_BASE)
            out += h[j:j + n]
    return mix(out, seed)


class Texts:
    """Words of several texts at once: one byte array, texts apart by a line break."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            self.data = LOWER[self.data]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.start, self.end = word_bounds(self.data)
        #: words of text i are first[i]:first[i+1]
        self.first = np.searchsorted(self.start, self.text_start)
        self.n_words = np.diff(self.first)
        self.text_of = np.repeat(np.arange(len(texts)), self.n_words)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.start, self.end)

    def whole_windows(self, k: int) -> np.ndarray:
        """Which of the runs of k consecutive words lie in one text."""
        n = len(self.start) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        return self.text_of[:n] == self.text_of[k - 1:]
