"""Vectorised 64-bit hashing of substrings and words of a byte array."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(32)
_LOWER += np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2^64; grows as needed and is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0], m = 1, 1
        while m < size:
            k = min(m, size - m)
            have[m : m + k] = have[:k] * np.uint64(pow(base, m, 1 << 64))
            m += k
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hash of any substring of values (1 .. 256) from two prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self._sum[1:])
        self._inverse = powers(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._inverse[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of the size, by their start."""
        n = len(self._sum) - 1
        return mix((self._sum[size:] - self._sum[: n + 1 - size]) * self._inverse[: n + 1 - size])


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of ASCII-lower-cased text, cut at ASCII white space."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return Prefix(_LOWER[raw])(starts, ends)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one run."""
    if not text:
        return np.empty(0, np.uint64)
    w = word_hashes(text)
    n = min(size, len(w))
    if not n:
        return np.empty(0, np.uint64)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(_BASE) + w[i : len(w) - n + 1 + i])
    return np.unique(h)
