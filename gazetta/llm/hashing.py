"""Vectorised hashes of the words of a text."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_U64 = (1 << 64) - 1
VALUES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], "u1")
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_powers: list[np.ndarray] = [np.ones(1, "u8"), np.ones(1, "u8")]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, "u8")
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each run of bytes other than ASCII white space, A-Z in lower case, in order.

    Prefix sums of byte values times powers give the polynomial hash of any range at once.
    """
    if not text:
        return np.empty(0, "u8")
    a = _LOWER[np.frombuffer(text, "u1")]
    inside = np.concatenate([[False], ~_SPACE[a], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(len(a) + 1)
    sums = np.zeros(len(a) + 1, "u8")
    np.cumsum(VALUES[a] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8"))


def combine(columns: list[np.ndarray], salt: int) -> np.ndarray:
    """One hash of the values that stand at the same place of each column."""
    out = np.full(len(columns[0]), (salt * 0xD6E8FEB86659FD93 + 1) & _U64, "u8")
    for c in columns:
        out = mix(out ^ c) * np.uint64(0xA0761D6478BD642F) + np.uint64(1)
    return out


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of `width` words; of fewer words, the whole sequence as one."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    return np.unique(combine([words[i : n - width + 1 + i] for i in range(width)], width))
