"""BM25 weights over a corpus of pieces, and an order in which related pieces are near.

The order is by cluster, then by consistent samples of a piece's terms, drawn in proportion to
their weights, then by a hash of the piece, so that copies are neighbours. Clusters are those
of random projections of the weighted terms. Their centres are fitted on at most about
``SAMPLE`` distinct pieces, chosen by hash; every piece is then assigned. Centres are numbered
along a path from each to the nearest one left, so clusters that are alike are near too.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import xxhash

K1, B = 1.2, 0.75
COORDINATES = 4
DIMENSIONS = 128
CLUSTERS = 128
SAMPLE = 8192
STEPS = 8
SEED = 7


class Statistics(NamedTuple):
    """What BM25 needs of the whole corpus: a weight per term, and the pieces' mean length.

    A term of a single piece weighs nothing, as no other piece shares it.
    """

    idf: np.ndarray
    mean: float

    @classmethod
    def of(cls, df: np.ndarray, n: int, tokens: int) -> Statistics:
        idf = np.where(df > 1, np.log1p((n - df + 0.5) / (df + 0.5)), 0)
        return cls(idf.astype(np.float32), tokens / max(1, n))

    def weights(self, terms: np.ndarray, counts: np.ndarray, length: np.ndarray) -> np.ndarray:
        norm = K1 * (1 - B + B * length / self.mean)
        return self.idf[terms] * counts * np.float32(K1 + 1) / (counts + norm)


class TermTable(NamedTuple):
    """Distinct terms of some pieces: per entry its piece, term and count, and where each
    piece begins."""

    pieces: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, pieces: list[np.ndarray]) -> TermTable:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.concatenate([*pieces, np.zeros(0, np.uint16)]).astype(np.uint64)
        flat |= np.repeat(np.arange(len(pieces), dtype=np.uint64), lengths) << np.uint64(32)
        flat.sort()
        first = np.flatnonzero(np.append(len(flat) > 0, flat[1:] != flat[:-1])[: len(flat)])
        counts = np.diff(np.append(first, len(flat))).astype(np.float32)
        own = (flat[first] >> np.uint64(32)).astype(np.int64)
        terms = (flat[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return cls(own, terms, counts, np.searchsorted(own, np.arange(len(pieces) + 1)))


@lru_cache(maxsize=1)
def _draws(terms: int) -> np.ndarray:
    return np.random.default_rng(SEED).exponential(size=(COORDINATES, terms)).astype(np.float32)


@lru_cache(maxsize=1)
def _sketch(terms: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimension that each term counts in, and its sign."""
    rng = np.random.default_rng(SEED + 1)
    return rng.integers(0, DIMENSIONS, terms), 2.0 * rng.integers(0, 2, terms) - 1


def _weighted(pieces: list[np.ndarray], stats: Statistics) -> tuple[TermTable, np.ndarray]:
    """Terms that weigh something, and their weights."""
    table = TermTable.of(pieces)
    lengths = np.fromiter(map(len, pieces), np.float32, len(pieces))
    weights = stats.weights(table.terms, table.counts, lengths[table.pieces])
    heavy = weights > 0
    own = table.pieces[heavy]
    begin = np.searchsorted(own, np.arange(len(pieces) + 1))
    return TermTable(own, table.terms[heavy], table.counts[heavy], begin), weights[heavy]


def projections(table: TermTable, weights: np.ndarray, stats: Statistics) -> np.ndarray:
    """One vector of length one per piece, its terms' weights counted with their signs."""
    n = len(table.begin) - 1
    dimension, sign = _sketch(len(stats.idf))
    cells = table.pieces * DIMENSIONS + dimension[table.terms]
    summed = np.bincount(cells, weights * sign[table.terms], minlength=n * DIMENSIONS)
    vectors = summed.reshape(n, DIMENSIONS).astype(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def fit_centres(pieces: list[np.ndarray], stats: Statistics) -> np.ndarray:
    """Centres of clusters by cosine, in the order of a path through them."""
    if not pieces:
        return np.zeros((1, DIMENSIONS), np.float32)
    vectors = projections(*_weighted(pieces, stats), stats)
    picked = np.random.default_rng(SEED).permutation(len(vectors))[:CLUSTERS]
    centres = vectors[picked].copy()
    for _ in range(STEPS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        met = np.bincount(nearest, minlength=len(centres)) > 0
        centres[met] = sums[met]
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    alike = centres @ centres.T
    path, left = [0], set(range(1, len(centres)))
    while left:
        path.append(max(left, key=lambda c: (alike[path[-1], c], -c)))
        left.remove(path[-1])
    return centres[path]


def _samples(table: TermTable, weights: np.ndarray, stats: Statistics) -> np.ndarray:
    """Per piece the terms with the least draw for their weight, plus one; 0 without terms."""
    n = len(table.begin) - 1
    picked = np.zeros((n, COORDINATES), ">u4")
    filled = np.flatnonzero(np.diff(table.begin))
    for c, draws in enumerate(_draws(len(stats.idf))) if len(filled) else ():
        race = draws[table.terms] / weights
        least = np.zeros(n, race.dtype)
        least[filled] = np.minimum.reduceat(race, table.begin[filled])
        won = np.flatnonzero(race == least[table.pieces])
        picked[table.pieces[won][::-1], c] = table.terms[won][::-1] + 1
    return picked


def sort_keys(
    pieces: list[np.ndarray], stats: Statistics, centres: np.ndarray
) -> list[bytes]:
    """Cluster, sampled terms and hash of each piece, as bytes that sort."""
    table, weights = _weighted(pieces, stats)
    clusters = (projections(table, weights, stats) @ centres.T).argmax(axis=1)
    clusters[np.diff(table.begin) == 0] = 0
    return [
        cluster.tobytes() + picked.tobytes() + xxhash.xxh64_digest(piece.tobytes())
        for cluster, picked, piece in zip(
            clusters.astype(">u2"), _samples(table, weights, stats), pieces
        )
    ]
