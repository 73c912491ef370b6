"""Ordering work for keys too large for one task.

A window over a key orders all of that key's rows in one task. One key may hold a third of a
table, so large keys are found first (a count per key, combined before the shuffle) and their
rows are range-partitioned by key and order: each block is a contiguous stretch of one key.
Callers order inside blocks and then stitch the block edges, of which there are two per block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint, rows_per_block

BLOCK, PREVIOUS = "__cf_block", "__cf_previous"
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Split:
    cold: DataFrame
    hot: DataFrame | None = None


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], limit: int | None = None) -> Split:
    """Rows of ordinary keys, and rows of keys above the limit tagged with their block."""
    limit = rows_per_block(df.sparkSession, limit)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cf_rows")).where(F.col("__cf_rows") > limit)
    found = large.agg(F.count(F.lit(1)).alias("keys"), F.sum("__cf_rows").alias("rows")).first()
    if not found.keys:
        return Split(df)
    # At most rows/limit keys are large; the set is written once so both joins see the same keys.
    hot_keys = checkpoint(large.select(*keys))
    if found.keys <= BROADCAST_KEYS:
        hot_keys = F.broadcast(hot_keys)
    blocks = max(2, math.ceil(found.rows / limit))
    hot = df.join(hot_keys, list(keys), "left_semi").repartitionByRange(blocks, *keys, *order)
    return Split(
        cold=df.join(hot_keys, list(keys), "left_anti"),
        hot=hot.withColumn(BLOCK, F.spark_partition_id()),
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: Sequence[str], limit: int | None = None
) -> DataFrame:
    """Add ``__cf_previous``, a struct of the given columns of the key's preceding row (or NULL)."""
    by = lambda *part: Window.partitionBy(*part).orderBy(*order)

    def lagged(frame, w, target):
        # Lag plain columns: a lagged struct would be built before the shuffle and travel with it.
        marks = {f"__cf_p{i}": F.lag(c).over(w) for i, c in enumerate(columns)}
        values = F.struct(*[F.col(f"__cf_p{i}").alias(c) for i, c in enumerate(columns)])
        frame = frame.withColumns({**marks, "__cf_any": F.lag(F.lit(True)).over(w)})
        return frame.withColumn(target, F.when(F.col("__cf_any"), values)).drop(*marks, "__cf_any")

    split = split_hot(df, keys, order, limit)
    out = lagged(split.cold, by(*keys), PREVIOUS)
    if split.hot is None:
        return out
    w = by(*keys, BLOCK)
    last = F.lead(F.lit(True)).over(w).isNull()
    inside = checkpoint(lagged(split.hot, w, PREVIOUS).withColumn("__cf_last", last))
    first = F.col(PREVIOUS).isNull()
    carried = lagged(inside.where(first | F.col("__cf_last")), by(*keys), "__cf_carried").where(first)
    for part in (inside.where(~first), carried.withColumn(PREVIOUS, F.col("__cf_carried"))):
        out = out.unionByName(part.select(*out.columns))
    return out
