"""Vectorised hashes of words, prefixes and shingles in a buffer of UTF-8 texts.

A polynomial in an odd base modulo 2**64 gives the hash of any byte range from
one prefix sum; every byte value has its own random 64-bit coefficient and a
bijective mixer finishes the value, so equal ranges have equal hashes and
different ones differ but for about one pair in 2**60.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
COEFF = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
SHINGLE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | U(1)
_POWERS: dict[int, np.ndarray] = {}

#: ASCII white space that separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Maps A-Z to a-z and every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            step = pow(base, done, 2**64)
            have[done:2 * done] = have[:done] * U(step)
            done *= 2
        _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


class Ranges:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(COEFF[data] * powers(BASE, n) if n else np.zeros(0, np.uint64), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(h + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Byte ranges of the words between ``space`` bytes, and each text's first word.

    Returns ``(start, end, first)``: ``first[i]:first[i+1]`` are text i's words.
    """
    inside = ~space[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begin[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def shingles(h: np.ndarray, first: np.ndarray, k: int):
    """Hashes of every k words in a row within a text, in order.

    A text with one to k-1 words gives one shingle, its whole sequence.
    Returns ``(hashes, first)`` as ``words`` does.
    """
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(n, out=out_first[1:])
    total = int(out_first[-1])
    at = np.arange(total) + np.repeat(first[:-1] - out_first[:-1], n)
    size = np.repeat(np.minimum(counts, k), n)
    acc = size.astype(np.uint64) * U(0x632BE59BD9B4E019)
    for j in range(k):
        live = size > j
        if live.all():
            acc += h[at + j] * SHINGLE[j]
        else:
            acc[live] += h[at[live] + j] * SHINGLE[j]
    return mix(acc), out_first
