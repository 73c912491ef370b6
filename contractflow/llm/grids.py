"""Blocks of vectors: queries against all rows, block by block.

Rows are packed, without a shuffle, into blocks of at most so many rows; a packed block is one row with binary columns. A
stated query set meets all blocks through an equi-join on a slot: every candidate block lies in one slot, every
block of queries in all of them. Slots are as many as candidate blocks can be, so tasks hold a few blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, spread

CANDIDATES = 8192
QUERIES = 256
QUERY_EVERY = 100
PACKED = "block long, n int, ids binary, vectors binary"


def usable(frame: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """Rows (key, vector as doubles) whose key and vector have no null and whose components are finite; zero vectors if asked."""
    values = F.col(vector).cast("array<double>")
    rows = frame.select(F.col(key).cast("long").alias("key"), values.alias("vector"))
    rows = rows.where(F.col("key").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return rows if zero else rows.where(F.exists("vector", lambda x: x != 0))


def pack(rows: DataFrame, size: int, change: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> DataFrame:
    """Blocks of at most ``size`` rows that stand together in a task; all vectors of a block have one length."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, vectors = batch.column(0).to_numpy(), batch.column(1)
        lengths = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy()
        begins = np.concatenate(([0], np.cumsum(lengths)))
        for length in np.unique(lengths):
            at = np.nonzero(lengths == length)[0]
            for i in range(0, len(at), size):
                some = at[i : i + size]
                matrix = change(values[begins[some][:, None] + np.arange(length)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(keys[some].min())]), pa.array([len(some)], pa.int32()), pa.array([keys[some].tobytes()]), pa.array([np.ascontiguousarray(matrix).tobytes()])],
                    names=["block", "n", "ids", "vectors"],
                )

    return map_batches(rows, work, PACKED)


def search(rows: DataFrame, work: Callable, kind: str, prepare: Callable, change: Callable = lambda x: x, candidates: int = CANDIDATES, queries: int = QUERIES, score: str = "double") -> DataFrame:
    """What ``work(index of a block, query ids, query vectors)`` finds in every block: query_id, vec_id, score.

    ``rows`` has key and vector; queries are the rows whose key is divisible by ``QUERY_EVERY`` (of repeated ones the
    smallest vector). ``prepare(ids, vectors)`` makes a block's index, kept while the block's rows follow each other.
    ``kind`` is the numpy type that ``change`` turns vectors into, ``score`` the type of scores. Vectors of another length than the query's are no
    candidates. Slots are as many as the cores can use, more only when a slot would hold more than 32 blocks.
    """
    spark, total, number = rows.sparkSession, rows.count(), np.dtype(kind)
    slots = min(spread(total, candidates), max(spread(total, 32 * candidates), 2 * spark.sparkContext.defaultParallelism))
    held = checkpoint(pack(rows, candidates, change))
    held = held.withColumn("slot", F.pmod(F.xxhash64("block", "n"), F.lit(slots)))
    chosen = rows.where(F.col("key") % QUERY_EVERY == 0).groupBy("key").agg(F.min("vector").alias("vector"))
    asked = pack(chosen.repartition(spread(total, QUERY_EVERY * queries), "key"), queries, change)
    asked = asked.select(F.explode(F.expr(f"sequence(0L, {slots - 1}L)")).alias("slot"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("n").alias("q_n"))
    pairs = held.join(asked, "slot").select("ids", "vectors", "n", "q_ids", "q_vectors", "q_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                ids, vectors, n, q_ids, q_vectors, q_n = (c[row].as_py() for c in batch.columns)
                if len(vectors) // n != len(q_vectors) // q_n:
                    continue
                if last != ids:
                    last, index = ids, prepare(np.frombuffer(ids, np.int64), np.frombuffer(vectors, number).reshape(n, -1))
                found = work(index, np.frombuffer(q_ids, np.int64), np.frombuffer(q_vectors, number).reshape(q_n, -1))
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, f"query_id long, vec_id long, score {score}")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        some = np.nonzero(scores <= np.partition(scores, k - 1)[k - 1])[0]
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], scores[some]))[:k]]


def ranked(found: DataFrame, k: int, best_first: bool) -> DataFrame:
    """The k best of each query, from 1: highest scores first or lowest first; ties to the smaller vec_id."""
    order = F.col("score").desc() if best_first else F.col("score").asc()
    by = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return found.withColumn("rank", F.row_number().over(by).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
