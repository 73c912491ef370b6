"""Table history: SCD2 from snapshots and change events, SCD1, append-only and cursors.

Intervals are half-open ``[__START_AT, __END_AT)``; an open row has no end. Consecutive upserts
that agree on the tracked columns share one version; an upsert after a delete opens a new one.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contract import END_AT, RESCUED, START_AT, report_name
from ..errors import require
from ..session import checkpoint
from .blocks import BLOCK, split_hot
from .projection import current_rows, literal, name

#: Changed keys that may be sent to every task; beyond, Spark chooses the join.
BROADCAST_KEYS = 200_000
#: Buckets of digests that two histories are compared by.
DIGEST_BUCKETS = 4096
CONFLICT = "Two different events share one key and sequence; the source must order them"


def _columns(names: Iterable[str]) -> list[SparkColumn]:
    return [name(n) for n in names]


def _state(columns: Sequence[str]) -> SparkColumn:
    return F.struct(*_columns(columns)) if columns else F.struct(F.lit(0).alias("none"))


def _any(conditions: Iterable[SparkColumn]) -> SparkColumn:
    return functools.reduce(lambda a, b: a | b, conditions, F.lit(False))


def _payload(df: DataFrame, keys: Sequence[str], hidden: Iterable[str]) -> list[str]:
    return [c for c in df.columns if c not in set(keys) | set(hidden)]


def _tracked(payload: Sequence[str], tracked: Sequence[str] | None) -> list[str]:
    chosen = list(payload) if tracked is None else list(tracked)
    missing = sorted(set(chosen) - set(payload))
    require(not missing, f"Tracked columns are not published columns: {', '.join(missing)}")
    return chosen


# --- change events -------------------------------------------------------------------------


def _runs(rows: DataFrame, part: Sequence[str], payload: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Collapse ordered rows to runs of one state, keeping each run's last row.

    Input rows carry ``__cf_seq``, ``__cf_live``, ``__cf_until`` (an end already known, or NULL) and
    ``__cf_group`` (rows of one group never merge, unless it is NULL). The two windows share one
    partitioning and order, so rows are shuffled and sorted once.
    """
    w = Window.partitionBy(*_columns(part)).orderBy("__cf_seq")
    # Lag over plain columns: a lagged struct would be built before the shuffle and travel with it.
    lagged = dict(zip(["__cf_seq", "__cf_live", "__cf_group", *payload], itertools.count()))
    before = {c: F.col(f"__cf_p{i}") for c, i in lagged.items()}
    differs = lambda columns: _any(~before[c].eqNullSafe(name(c)) for c in columns)
    conflict = before["__cf_seq"].eqNullSafe(F.col("__cf_seq")) & (differs(["__cf_live"]) | differs(payload))
    changed = (
        before["__cf_live"].isNull()
        | differs(["__cf_live"])
        | (F.col("__cf_live") & differs(tracked))
        | F.coalesce(before["__cf_group"] == F.col("__cf_group"), F.lit(False))
    )
    marked = rows.withColumns({f"__cf_p{i}": F.lag(name(c)).over(w) for c, i in lagged.items()}).withColumn(
        "__cf_starts", F.when(conflict, F.raise_error(F.lit(CONFLICT)).cast("boolean")).otherwise(changed)
    )
    opening = F.when(F.col("__cf_starts"), F.struct("__cf_seq", before["__cf_live"].isNull().alias("first")))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = marked.withColumns(
        {
            "__cf_open": F.last(opening, ignorenulls=True).over(running),
            "__cf_after": F.lead(F.struct("__cf_seq", "__cf_starts")).over(w),
        }
    ).where(F.col("__cf_after").isNull() | F.col("__cf_after.__cf_starts"))
    return ended.select(
        *_columns(part),
        *_columns(payload),
        "__cf_live",
        F.col("__cf_open.__cf_seq").alias("__cf_seq"),
        F.coalesce("__cf_until", "__cf_after.__cf_seq").alias("__cf_until"),
        F.col("__cf_open.first").alias("__cf_first"),
        F.col("__cf_after").isNull().alias("__cf_last"),
    )


def event_runs(
    events: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    operation: str | None = None,
    tracked: Sequence[str] | None = None,
    drop: Iterable[str] = (),
    block_rows: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """Runs of one state per key, deleted runs included, and the published column names."""
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)
    hidden = {operation, RESCUED, *drop, *sequence}
    payload = _payload(events, keys, hidden)
    tracked = _tracked(payload, tracked)
    published = [c for c in events.columns if c not in hidden]
    rows = events.select(
        *_columns(keys),
        *_columns(payload),
        (name(sequence[0]) if len(sequence) == 1 else F.struct(*_columns(sequence))).alias("__cf_seq"),
        (~name(operation).eqNullSafe("D") if operation else F.lit(True)).alias("__cf_live"),
    )
    rows = rows.withColumn("__cf_until", F.when(F.lit(False), F.col("__cf_seq")))
    split = split_hot(rows, keys, ["__cf_seq"], block_rows)
    final = ["__cf_live", "__cf_seq", "__cf_until"]
    out = _runs(split.cold.withColumn("__cf_group", F.lit(None).cast("int")), list(keys), payload, tracked)
    out = out.select(*_columns(keys), *_columns(payload), *final)
    if split.hot is not None:
        inside = _runs(split.hot.withColumn("__cf_group", F.lit(None).cast("int")), [*keys, BLOCK], payload, tracked)
        inside = checkpoint(inside)  # block numbers must be the same for both branches below
        edge = F.col("__cf_first") | F.col("__cf_last")
        edges = inside.where(edge).withColumn("__cf_group", name(BLOCK))
        for part in (inside.where(~edge), _runs(edges, list(keys), payload, tracked)):
            out = out.unionByName(part.select(*_columns(keys), *_columns(payload), *final))
    return out, published


def scd2_from_events(events: DataFrame, keys: Sequence[str], sequence: str | Sequence[str], **settings) -> DataFrame:
    """SCD2 history of full-row I/U/D events, in any arrival order.

    Events are ordered by ``sequence`` (several columns order as a struct). Exact duplicates
    collapse; different events with one key and sequence fail the query.
    """
    runs, published = event_runs(events, keys, sequence, **settings)
    return runs.where("__cf_live").select(
        *_columns(published), F.col("__cf_seq").alias(START_AT), F.col("__cf_until").alias(END_AT)
    )


def sequence_conflicts(
    events: DataFrame, keys: Sequence[str], sequence: str | Sequence[str], ignore: Iterable[str] = ()
) -> DataFrame:
    """Keys and sequences that carry more than one distinct event."""
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)
    group = [*keys, *sequence]
    body = [c for c in events.columns if c not in set(group) | {RESCUED, *ignore}]
    # Least and greatest fingerprint are plain numbers: they are hash-aggregated, combined before the shuffle, without sorting.
    bounds = [f(h).alias(f"__cf_{n}{i}") for i, h in enumerate(fingerprint(body)) for n, f in (("low", F.min), ("high", F.max))]
    found = events.groupBy(*group).agg(F.count(F.lit(1)).alias("__cf_events"), *bounds)
    differ = (F.col("__cf_low0") != F.col("__cf_high0")) | (F.col("__cf_low1") != F.col("__cf_high1"))
    return found.where(differ).select(*_columns(group), F.col("__cf_events").alias(report_name("events", group)))


# --- complete snapshots --------------------------------------------------------------------


def apply_snapshot(
    opened: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    version: int,
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """Open rows and the rows this snapshot closes, from the previously open rows.

    Keys are unique on both sides, so the full outer join is balanced. Closed history is not
    an input: it never changes.
    """
    payload = _payload(snapshot, keys, ())
    tracked = _tracked(payload, tracked)
    at = F.lit(int(version)).cast("bigint")
    if opened is None:
        return snapshot.select("*", at.alias(START_AT), F.lit(None).cast("bigint").alias(END_AT))
    old = opened.select(*_columns(keys), _state(payload).alias("__cf_old"), name(START_AT))
    new = snapshot.select(*_columns(keys), _state(payload).alias("__cf_new"))
    was, now = F.col("__cf_old"), F.col("__cf_new")
    kept = was.isNotNull() & now.isNotNull() & ~_any(~was[c].eqNullSafe(now[c]) for c in tracked)
    row = lambda body, start, end: F.struct(body.alias("__cf_row"), start.alias("__cf_start"), end.alias("__cf_end"))
    nothing = F.lit(None).cast("bigint")
    closing, opening = row(was, name(START_AT), at), row(now, at, nothing)
    # One branch per case keeps the expression inside generated code.
    outcome = (
        F.when(kept, F.array(row(now, name(START_AT), nothing)))
        .when(was.isNull(), F.array(opening))
        .when(now.isNull(), F.array(closing))
        .otherwise(F.array(closing, opening))
    )
    both = old.join(new, list(keys), "full_outer").select(*_columns(keys), F.inline(outcome))
    values = [name(c) if c in keys else F.col("__cf_row")[c].alias(c) for c in snapshot.columns]
    return both.select(*values, F.col("__cf_start").alias(START_AT), F.col("__cf_end").alias(END_AT))


def _prints(frame: DataFrame, keys: Sequence[str], columns: Sequence[str], mark: str) -> DataFrame:
    """Keys and fingerprints only: all of a row that has to travel until it is known to have changed."""
    return frame.select(*_columns(keys), *[f.alias(f"__cf_{mark}{i}") for i, f in enumerate(fingerprint(columns))])


def _same_prints() -> SparkColumn:
    return F.col("__cf_old0").eqNullSafe(F.col("__cf_new0")) & F.col("__cf_old1").eqNullSafe(F.col("__cf_new1"))


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys that are on one side only, or whose rows have different fingerprints."""
    both = _prints(old, keys, columns, "old").join(_prints(new, keys, columns, "new"), list(keys), "full_outer")
    return both.where(~_same_prints()).select(*_columns(keys))


def advance_snapshot(
    opened: DataFrame | None, snapshot: DataFrame, keys: Sequence[str], version: int, tracked: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``apply_snapshot``, for tables of which little changes between deliveries.

    Keys and fingerprints are compared first, and written once. Rows of unchanged keys go from the stored rows to the result without a
    shuffle; only the payload of changed keys is joined, and there the values themselves decide.
    """
    if opened is None:
        return apply_snapshot(None, snapshot, keys, version, tracked)
    changed = checkpoint(changed_keys(opened, snapshot, keys, _payload(snapshot, keys, ())))
    few = F.broadcast if changed.count() <= BROADCAST_KEYS else lambda frame: frame
    part = lambda frame, how: frame.join(few(changed), list(keys), how)
    moved = apply_snapshot(part(opened, "left_semi"), part(snapshot, "left_semi"), keys, version, tracked)
    return moved.unionByName(part(opened, "left_anti").select(*moved.columns))


def scd2_from_snapshots(
    history: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    version: int,
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """History after one more complete snapshot; keys absent from it expire."""
    if history is None:
        return apply_snapshot(None, snapshot, keys, version, tracked)
    changed = apply_snapshot(current_rows(history), snapshot, keys, version, tracked)
    return history.where(name(END_AT).isNotNull()).unionByName(changed)


def scd2_from_snapshot_series(
    snapshots: Sequence[tuple[int, DataFrame]],
    keys: Sequence[str],
    tracked: Sequence[str] | None = None,
    opened: DataFrame | None = None,
) -> DataFrame:
    """The same rows as applying the snapshots one by one, built in one shuffle.

    ``opened`` are open rows left by earlier snapshots. A key has at most one row per snapshot,
    so a window over a key holds at most as many rows as there are snapshots.
    """
    require(snapshots, "At least one snapshot is needed")
    series = sorted(snapshots, key=lambda item: item[0])
    versions = [int(v) for v, _ in series]
    require(len(set(versions)) == len(versions), "Snapshot versions are unique")
    columns = series[0][1].columns
    payload = _payload(series[0][1], keys, ())
    tracked = _tracked(payload, tracked)

    def tagged(frame, place, version):
        following = versions[place + 1] if place + 1 < len(versions) else None
        marks = [F.lit(place).alias("__cf_place"), version.alias("__cf_version"), F.lit(following).cast("bigint").alias("__cf_next")]
        return frame.select(*_columns(columns), *marks)

    frames = [tagged(frame, place, F.lit(v).cast("bigint")) for place, (v, frame) in enumerate(series)]
    if opened is not None:
        frames.append(tagged(opened, -1, name(START_AT)))
    rows = functools.reduce(DataFrame.unionByName, frames)
    w = Window.partitionBy(*_columns(keys)).orderBy("__cf_place")
    before = {c: F.col(f"__cf_p{i}") for i, c in enumerate(["__cf_place", *tracked])}
    starts = (
        before["__cf_place"].isNull()
        | (before["__cf_place"] + 1 != F.col("__cf_place"))
        | _any(~before[c].eqNullSafe(name(c)) for c in tracked)
    )
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening = F.last(F.when(F.col("__cf_starts"), F.col("__cf_version")), ignorenulls=True).over(running)
    # A run ends at the delivery after its last one: there the key changed or was missing.
    return (
        rows.withColumns({f"__cf_p{i}": F.lag(name(c)).over(w) for i, c in enumerate(before)})
        .withColumn("__cf_starts", starts)
        .withColumns({"__cf_open": opening, "__cf_ends": F.coalesce(F.lead("__cf_starts").over(w), F.lit(True))})
        .where("__cf_ends")
        .select(*_columns(columns), F.col("__cf_open").alias(START_AT), F.col("__cf_next").alias(END_AT))
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """Keys that were inserted, updated or deleted between two complete snapshots. Only keys and fingerprints are joined."""
    compare = _payload(new, keys, ()) if compare is None else list(compare)
    change = F.when(F.col("__cf_old0").isNull(), "insert").when(F.col("__cf_new0").isNull(), "delete").when(~_same_prints(), "update")
    joined = _prints(old, keys, compare, "old").join(_prints(new, keys, compare, "new"), list(keys), "full_outer")
    found = joined.select(*_columns(keys), change.alias("__cf_change")).where(F.col("__cf_change").isNotNull())
    return found.withColumnRenamed("__cf_change", report_name("change", keys))


# --- latest rows, increments and reconciliation ----------------------------------------------


def latest_rows(df: DataFrame, keys: Sequence[str], sequence: str | Sequence[str], conflicts: bool = True) -> DataFrame:
    """One row per key, the one with the greatest sequence; combined before the shuffle.

    Different rows that share a key's greatest sequence are a conflict: with ``conflicts`` left out the greatest of them is
    taken, otherwise they fail the query, as different events of one sequence do. Exact copies collapse.
    """
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)
    rest = [c for c in df.columns if c not in set(keys) | set(sequence)]
    top = F.max(F.struct(*_columns(sequence), *_columns(rest))).alias("__cf_top")
    if not conflicts or not rest:
        picked = df.groupBy(*_columns(keys)).agg(top)
        return picked.select(*[name(c) if c in keys else F.col("__cf_top")[c].alias(c) for c in df.columns])
    # Of the rows with the greatest sequence, the largest fingerprint and (by its complement) the smallest.
    prints = dict(zip(("__cf_f0", "__cf_f1"), fingerprint(rest), strict=True))
    marked = df.withColumns(prints)
    ends = [F.max(F.struct(*_columns(sequence), *[mark(F.col(f)).alias(f) for f in prints])) for mark in (lambda c: c, F.bitwise_not)]
    picked = marked.groupBy(*_columns(keys)).agg(top, ends[0].alias("__cf_high"), ends[1].alias("__cf_low"))
    differ = _any(F.col("__cf_high")[f] != F.bitwise_not(F.col("__cf_low")[f]) for f in prints)
    checked = F.when(differ, F.raise_error(F.lit(CONFLICT)).cast(picked.schema["__cf_top"].dataType)).otherwise(F.col("__cf_top"))
    picked = picked.select(*_columns(keys), checked.alias("__cf_top"))
    return picked.select(*[name(c) if c in keys else F.col("__cf_top")[c].alias(c) for c in df.columns])


def fingerprint(columns: Sequence[str]) -> tuple[SparkColumn, SparkColumn]:
    """Two 64-bit hashes of a row. Spark's hash passes over nulls, so where they are is hashed as well."""
    values = [*_columns(columns), *[name(c).isNull() for c in columns]]
    return F.xxhash64(F.lit(0), *values), F.xxhash64(F.lit(1), *values)


def scd1_merge(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    sequence: str | Sequence[str],
    deleted: str | None = None,
) -> DataFrame:
    """Latest row per key. A stored newer row is never replaced by an older one; with equal
    sequences the update wins over the stored row, and two different updates fail the query. Keys missing from the updates stay; only rows the extract flags
    with the ``deleted`` predicate leave.

    Only the updates are grouped: the target has one row per key and joins as it is.
    """
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)
    flag = F.coalesce(F.expr(deleted), F.lit(False)) if deleted else F.lit(False)
    latest = latest_rows(updates.withColumn("__cf_gone", flag), keys, sequence)
    if target is None:
        return latest.where(~F.col("__cf_gone")).drop("__cf_gone")
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    old = target.select(*_columns(keys), _state(rest).alias("__cf_old"))
    new = latest.select(*_columns(keys), _state(rest).alias("__cf_new"), "__cf_gone")
    at = lambda side: F.struct(*[F.col(side)[c] for c in sequence])
    wins = F.col("__cf_new").isNotNull() & (F.col("__cf_old").isNull() | (at("__cf_new") >= at("__cf_old")))
    row = F.when(wins, F.col("__cf_new")).otherwise(F.col("__cf_old")).alias("__cf_row")
    chosen = old.join(new, list(keys), "full_outer").where(~F.coalesce(wins & F.col("__cf_gone"), F.lit(False)))
    chosen = chosen.select(*_columns(keys), row)
    return chosen.select(*[name(c) if c in keys else F.col("__cf_row")[c].alias(c) for c in columns])


def append_only(target: DataFrame | None, increment: DataFrame) -> DataFrame:
    return increment if target is None else target.unionByName(increment)


def after_cursor(df: DataFrame, cursor: str, mark=None) -> DataFrame:
    """Rows beyond the high-water mark. Rows without a cursor value are not ingested."""
    if mark is None:
        return df.where(name(cursor).isNotNull())
    return df.where(name(cursor) > literal(mark, df.schema[cursor].dataType))


def high_water_mark(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.max(name(cursor)).alias("high_water_mark"))


def bucket_digests(frame: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Per bucket of fingerprints: the number of rows and the sums of their fingerprints, which do not depend on the order."""
    placed = frame.select(*[f.alias(f"__cf_f{i}") for i, f in enumerate(fingerprint(frame.columns))])
    whole = [F.sum(F.col(f).cast("decimal(20,0)")).alias(f) for f in placed.columns]
    return placed.groupBy(F.pmod("__cf_f0", F.lit(buckets)).alias("__cf_bucket")).agg(F.count(F.lit(1)).alias("__cf_n"), *whole)


def reconcile(left: DataFrame, right: DataFrame, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """Rows whose number of copies differs, with ``copies`` positive where left has more.

    An empty result means the two are equal. Digests of buckets are compared first: rows of equal buckets stay where they are,
    only those of the others are grouped. One grouping answers both directions.
    """
    minus = lambda c: -F.col(c)
    digests = bucket_digests(left, buckets)
    others = bucket_digests(right.select(*_columns(left.columns)), buckets)
    signed = digests.unionByName(others.select("__cf_bucket", *[minus(c).alias(c) for c in others.columns[1:]]))
    totals = signed.groupBy("__cf_bucket").agg(*[F.sum(c).alias(c) for c in others.columns[1:]])
    differing = F.broadcast(totals.where(_any(F.col(c) != 0 for c in others.columns[1:])).select("__cf_bucket"))  # at most ``buckets`` rows

    def rest(side: DataFrame, sign: int) -> DataFrame:
        placed = side.withColumn("__cf_bucket", F.pmod(fingerprint(side.columns)[0], F.lit(buckets)))
        return placed.join(differing, "__cf_bucket", "left_semi").drop("__cf_bucket").withColumn("__cf_n", F.lit(sign))

    sides = rest(left, 1).unionByName(rest(right.select(*_columns(left.columns)), -1))
    return sides.groupBy(*_columns(left.columns)).agg(F.sum("__cf_n").alias("__cf_copies")).where("__cf_copies <> 0").withColumnRenamed("__cf_copies", report_name("copies", left.columns))
