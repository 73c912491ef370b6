"""Exact top-k by inner product with sorted lists only: no-random-access aggregation within blocks of rows.

A block keeps one list per dimension, sorted by value. A query reads every list from its better end, level by level. What
has been read of a row bounds its score from below and above: an unread component is at worst the list's other end and at
best the value where reading stands. Reading stops when few rows can still be among the k best; their scores are then
resolved exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import grids

K = 10
SCALE = 1024
LEVELS = 8


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as doubles, which hold whole numbers of any size that a double's product can have."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * vectors), -np.finfo(np.float64).max, np.finfo(np.float64).max)


def wide(vectors: np.ndarray) -> np.ndarray:
    """Vectors whose inner product with one of their like may exceed 62 bits."""
    return np.abs(vectors).max(axis=1, initial=0) >= np.sqrt(2.0**62 / max(1, vectors.shape[1]))


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers of any length; what a long cannot hold counts as the largest or smallest long."""
    most, by = np.iinfo(np.int64).max, [int(x) for x in query]
    sums = (sum(int(x) * y for x, y in zip(row, by, strict=True)) for row in rows)
    return np.array([max(-most - 1, min(most, s)) for s in sums], np.int64)


class Lists:
    """Sorted lists of a block: ``order[j]`` has the rows by component j, greatest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        far = wide(vectors)
        self.all_ids, self.vectors = ids, vectors
        self.wide_ids, self.wide = ids[far], vectors[far]  # scored one by one, beside the lists
        ids, vectors = ids[~far], vectors[~far].astype(np.int64)
        self.ids, self.rows, self.columns = ids, vectors, np.ascontiguousarray(vectors.T)
        self.order = np.argsort(-self.columns, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.columns, self.order, axis=1)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's k best rows for a query, other than the query's own."""
        if wide(query[None])[0]:
            ids, scores = self.all_ids, exact(self.vectors, query)
        else:
            ids, scores = self.listed(own, query.astype(np.int64), k)
            if len(self.wide_ids):
                ids, scores = np.concatenate((ids, self.wide_ids)), np.concatenate((scores, exact(self.wide, query)))
        other = np.nonzero(ids != own)[0]
        # The complement orders as the negative does, and the smallest long has one.
        chosen = other[grids.best(ids[other], ~scores[other], k)]
        return ids[chosen], scores[chosen]

    def listed(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of rows of the lists among which are the k best, other than the query's own."""
        n, up, down = len(self.ids), np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
        used = np.concatenate((up, down))
        weights = query[used].astype(np.float64)[:, None]
        allowed = self.ids != own
        low = np.zeros(n)
        # Bounds are sums of doubles: they may be off by a little of the largest products.
        sizes = np.maximum(np.abs(self.sorted[used, 0]), np.abs(self.sorted[used, -1])) if n else np.zeros(len(used))
        slack = (np.abs(weights[:, 0]) * sizes).sum() * 2.0**-45
        read, alive = 0, np.nonzero(allowed)[0]
        for level in range(1, LEVELS + 1):
            depth = n * level // LEVELS
            if depth == read or not len(used):
                continue
            # The better end of a list is its front for a positive weight and its back for a negative one.
            at = np.concatenate((self.order[up, read:depth], self.order[down, n - depth : n - read]))
            values = np.concatenate((self.sorted[up, read:depth], self.sorted[down, n - depth : n - read]))
            ends = weights[:, 0] * np.concatenate((self.sorted[up, -1], self.sorted[down, 0]))
            low += np.bincount(at.ravel(), (weights * values - ends[:, None]).ravel(), n)
            read = depth
            frontier = weights[:, 0] * np.concatenate((self.sorted[up, depth - 1], self.sorted[down, n - depth]))
            gap = frontier - ends  # by so much an unread component can exceed its worst
            seen = np.concatenate((self.order[up, :depth], self.order[down, n - depth :]))
            open_gap = gap.sum() - np.bincount(seen.ravel(), np.repeat(gap, depth), n)
            bounds = low[alive]
            if len(alive) <= k:
                break
            kth = np.partition(bounds, len(bounds) - k)[len(bounds) - k]
            alive = alive[bounds + open_gap[alive] >= kth - slack]
            if len(alive) <= 8 * k:
                break
        return self.ids[alive], self.rows[alive] @ query


def search(lists: Lists, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [lists.top(own, query, k) for own, query in zip(q_ids, queries, strict=True)]
    sizes = [len(ids) for ids, _ in found]
    return np.repeat(q_ids, sizes), np.concatenate([ids for ids, _ in found]), np.concatenate([scores for _, scores in found])


def top_k(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, candidates: int = grids.CANDIDATES) -> DataFrame:
    """The k greatest inner products of each query: query_id, rank, vec_id, score; exact, ties to the smaller vec_id.

    Components x count as floor(1024 * x). Rows with a null key, a null or empty vector, or a null or non-finite component
    take no part; zero vectors do. Rows that share a key are separate candidates, and none of them is one for a query of that
    key. Vectors of other lengths than the query's are no candidates. Components may be as large as doubles are: products are then
    taken in whole numbers of any length, and a score that a long cannot hold is the largest or smallest long. An empty table gives no rows.
    """
    usable = grids.usable(rows, key, vector, zero=True)
    found = grids.search(usable, lambda lists, ids, queries: search(lists, ids, queries, k), "float64", Lists, whole_numbers, candidates, score="long")
    return grids.ranked(found, k, best_first=True)


SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
