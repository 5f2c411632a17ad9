"""Words of many texts at once, as 64-bit fingerprints in Numpy arrays.

A word is a run of bytes other than space and 9 to 13. Its fingerprint is a polynomial of
its bytes modulo 2**64 with random coefficients per byte value, followed by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_SEED = 20240101
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_COEFFICIENT = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for a power of two ``n`` of positions."""
    result = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n, base, _U)
        p[0] = 1
        result.append(np.multiply.accumulate(p))
    return result[0], result[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, int(n).bit_length()))
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """``s`` with ``(s[j] - s[i]) * down[i]`` the polynomial of ``values[i:j]``."""
    up, _ = powers(len(values))
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up, out=sums[1:])
    return sums


def byte_coefficients(data: np.ndarray) -> np.ndarray:
    return _COEFFICIENT[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_fingerprints(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of all texts, and the offsets at which each text begins."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = word_spans(data)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if texts else np.zeros(0, np.int64)
    offsets = np.append(np.searchsorted(starts, begins), len(starts)).astype(np.int64)
    if not len(starts):
        return np.zeros(0, _U), offsets
    sums = prefix_sums(byte_coefficients(data))
    _, down = powers(len(data))
    return mix((sums[ends] - sums[starts]) * down[starts]), offsets


def gram_fingerprints(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of every ``n`` consecutive values, across texts; the caller masks those."""
    if len(words) < n:
        return np.zeros(0, _U)
    sums = prefix_sums(words)
    _, down = powers(len(words))
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def slices(texts: list[bytes], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges over ``texts`` of about ``limit`` bytes, at least one text each."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
