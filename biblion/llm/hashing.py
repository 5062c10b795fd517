"""Vectorised hashes of words and of runs of words, for use in Arrow functions."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
#: Odd multipliers of the two polynomials over bytes and over words.
BYTE_BASE, WORD_BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)], dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS: dict[int, Powers] = {}


def powers(base: int) -> Powers:
    return _POWERS.setdefault(base, Powers(base))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    solid = ~_BLANK[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    return edges[::2], edges[1::2]


def rolled(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial hash of values[start:end] for each pair, from running sums."""
    up, down = powers(base).upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a text, and where the words begin and end."""
    starts, ends = words_of(raw)
    text = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    # the length of a word is part of its hash
    return mixed(rolled(text, BYTE_BASE, starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), starts, ends
