"""Approximate nearest neighbours by multi-index hashing of learned, rotated binary codes.

A bounded sample teaches the codes: the sample's mean and principal axes, and rotations that bring the coordinates near the
corners of a cube (iterative quantisation). Every row has a code; in each block, the code's substrings of 16 bits are indexed
one by one. A code within Hamming radius r of a query's agrees with it in some substring up to r / substrings bits, so
probing the substrings' buckets in order of flipped bits retrieves every code within a radius that grows from 0. Probing stops
when so many codes lie within the radius that is complete; the vectors themselves rank those.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grids

K = 10
BITS = 128
SUBSTRING = 16
#: Rows that the codes are learned from: those with the smallest hashes of their ids.
SAMPLE = 8192
#: Nearest codes of a block whose vectors are compared, for each neighbour that is asked for.
RERANK = 100
TURNS = 30


@dataclass(frozen=True)
class Codes:
    """A coder for vectors of one length: bit i is set where the i-th rotated coordinate is positive."""

    mean: np.ndarray
    axes: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as unsigned 16-bit substrings, one row per vector."""
        bits = (vectors - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances between rows of substrings (one of the two may be a single row)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn(sample: np.ndarray, bits: int = BITS, seed: int = 7) -> Codes:
    """Codes for vectors of the sample's length."""
    width = sample.shape[1]
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    _, _, axes = np.linalg.svd(sample - mean, full_matrices=False)
    axes = axes[: min(len(axes), width)]
    found = (sample - mean) @ axes.T
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        turn = np.linalg.qr(rng.normal(size=(len(axes), len(axes))))[0]
        for _ in range(TURNS):
            u, _, v = np.linalg.svd(np.sign(found @ turn).T @ found)
            turn = (u @ v).T
        parts.append(axes.T @ turn)
    return Codes(mean, np.ascontiguousarray(np.concatenate(parts, axis=1)[:, :bits]))


def flips(bits: int = SUBSTRING) -> list[np.ndarray]:
    """The values of a substring with 0, 1, 2, ... bits set: what is flipped to reach the buckets at that distance."""
    values = np.arange(1 << bits, dtype=np.uint16)
    ones = np.bitwise_count(values)
    return [values[ones == n] for n in range(bits + 1)]


FLIPS = flips()


class Table:
    """One substring of a block's codes: rows in order of their value, and where the bucket of each possible value begins."""

    def __init__(self, column: np.ndarray):
        self.order = np.argsort(column, kind="stable")
        self.values = np.unique(column)
        self.begin = np.searchsorted(column[self.order], np.arange((1 << SUBSTRING) + 1))

    def probe(self, value: np.uint16, flipped: int) -> np.ndarray:
        """Rows whose substring differs in exactly so many bits: by the buckets at that distance, or by those that have rows, whichever are fewer."""
        buckets = FLIPS[flipped] ^ value
        if len(buckets) > len(self.values):
            buckets = self.values[np.bitwise_count(self.values ^ value) == flipped]
        starts = self.begin[buckets]
        sizes = self.begin[buckets.astype(np.int64) + 1] - starts
        some = np.nonzero(sizes)[0]
        starts, sizes = starts[some], sizes[some]
        return self.order[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


class MultiIndex:
    """The codes of a block, with a table for each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Codes):
        self.ids, self.rows, self.coder = ids, vectors, coder
        self.codes = coder.of(vectors)
        self.tables = [Table(column) for column in self.codes.T]

    def nearest_codes(self, own: int, code: np.ndarray, want: int) -> tuple[np.ndarray, int]:
        """At least ``want`` rows (all, if fewer) other than the query's own: all codes within the smallest radius that has so many; and the rows looked at.

        If none of the first i + 1 tables has a row within f flipped bits and none of the others within f - 1, its code differs in more
        than tables * f + i bits. So after those probes, every code within that radius was seen.
        """
        parts, fresh = len(self.tables), self.ids != own
        rows, apart, within = [], [], np.zeros(parts * SUBSTRING + 1, np.int64)
        most, total = min(want, int(fresh.sum())), 0
        for step in range(parts * (SUBSTRING + 1)):
            flipped, i = divmod(step, parts)
            found = self.tables[i].probe(code[i], flipped)
            found = found[fresh[found]]
            if len(found):
                fresh[found] = False
                gaps = distances(self.codes[found], code)
                rows.append(found)
                apart.append(gaps)
                within += np.bincount(gaps, minlength=len(within))
                total += len(found)
            if within[: step + 1].sum() >= most:
                break
        if not rows:
            return np.zeros(0, np.int64), 0
        rows, apart = np.concatenate(rows), np.concatenate(apart)
        radius = int(np.searchsorted(np.cumsum(within), most))
        return rows[apart <= radius], total

    def top(self, own: int, query: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the nearest among the rows with the nearest codes."""
        rows, _ = self.nearest_codes(own, code, RERANK * k)
        scores = np.sqrt(((self.rows[rows] - query) ** 2).sum(axis=1))
        chosen = grids.best(self.ids[rows], scores, k)
        return self.ids[rows][chosen], scores[chosen]


def search(index: MultiIndex, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [index.top(own, query, code, k) for own, query, code in zip(q_ids, queries, index.coder.of(queries), strict=True)]
    return np.repeat(q_ids, [len(ids) for ids, _ in found]), np.concatenate([ids for ids, _ in found]), np.concatenate([s for _, s in found])


def sampled(rows: DataFrame, size: int = SAMPLE) -> dict[int, np.ndarray]:
    """At most ``size`` vectors, by their length."""
    found = rows.orderBy(F.xxhash64("key"), "key").limit(size).select("vector").collect()
    by_length: dict[int, list] = {}
    for r in found:
        by_length.setdefault(len(r.vector), []).append(r.vector)
    return {length: np.array(vectors) for length, vectors in by_length.items()}


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, sample: int = SAMPLE, candidates: int = grids.CANDIDATES) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score (Euclidean distance), ties to the smaller vec_id.

    Rows with a null key, a null or empty or zero vector, or a null or non-finite component take no part. Rows that share a key
    are separate candidates, and none of them is one for a query of that key. Vectors of other lengths than the query's are no
    candidates; a length that the sample does not hold has codes learned from each block. An empty table gives no rows.
    """
    usable = grids.usable(rows, key, vector, zero=False)
    coders = {length: learn(vectors) for length, vectors in sampled(usable, sample).items()}

    def prepare(ids: np.ndarray, vectors: np.ndarray) -> MultiIndex:
        coder = coders.get(vectors.shape[1]) or learn(vectors)
        return MultiIndex(ids, vectors, coder)

    found = grids.search(usable, lambda index, ids, queries: search(index, ids, queries, k), "float64", prepare, candidates=candidates)
    return grids.ranked(found, k, best_first=False)
