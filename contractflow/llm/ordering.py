"""Running totals and ranks over an order of any length, without ordering one key's rows in a single task.

Rows are cut by a bucket that grows with the order; totals per bucket are few (about the square root of the rows),
so their prefix sums are cheap, and each bucket is ordered by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 32


def bucket_count(rows: int) -> int:
    """Buckets for so many rows: the square root keeps both the buckets and the rows in each few."""
    return max(1, math.isqrt(max(0, rows - 1)) + 1)


def hex_bucket(digest: Column, buckets: int) -> Column:
    """Bucket of a hexadecimal digest, in the digest's own order."""
    first = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")
    return F.shiftright(first * F.lit(buckets), HASH_BITS).cast("long")


def running(frame: DataFrame, group: list[str], bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the group's rows before this one, by bucket, then by ``order``."""
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    frame = frame.withColumn("_v", value)
    totals = frame.groupBy(*group, bucket).agg(F.sum("_v").alias("_total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0).cast("long"))).drop("_total")
    within = frame.withColumn("_within", F.sum("_v").over(inside) - F.col("_v"))
    return within.join(offsets, [*group, bucket]).withColumn(name, F.col("_before") + F.col("_within")).drop("_v", "_before", "_within")
