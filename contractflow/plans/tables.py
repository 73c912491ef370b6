"""Tables ingested from databases, folders and object extracts: SCD1, SCD2 or append-only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import END_AT, START_AT, Contract, spark_type
from ..errors import DataRejected, require
from ..functions.rules import MANAGED, compile_rules
from ..operators import history
from ..operators.projection import name
from ..operators.verify import duplicate_keys
from ..session import checkpoint
from ..sources.datasets import BUCKET, OPEN, TABLE, Dataset, Version
from .views import after_load

SCD1, SCD2, APPEND_ONLY = "SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY"


@dataclass(frozen=True)
class TableFlow:
    """Bring a target up to date with its source.

    ``source`` reads the source beyond a high-water mark (None means all of it). With a cursor
    only newer rows are read; without one every run is a full refresh. SCD1 and SCD2 tables with a cursor are kept in
    ``buckets`` by key, and a run reads and writes the buckets that its rows fall into. Choose them once, so that a bucket is
    a few gigabytes; their number is fixed when the target is created.
    """

    target: str
    contract: Contract
    source: Callable[[SparkSession, SparkColumn | None], DataFrame]
    mode: str = SCD1
    cursor: str | None = None
    deleted: str | None = None
    unsupported: str = "error"
    results: str | None = None
    buckets: int = 64

    def __post_init__(self):
        require(self.mode in (SCD1, SCD2, APPEND_ONLY), "Unknown history mode")
        require(self.mode == APPEND_ONLY or self.contract.keys, f"{self.mode} needs primary keys in the contract")
        require(self.cursor is None or self.contract.by_source(self.cursor), "Unknown cursor column")
        compile_rules(self.contract, MANAGED, self.unsupported)
        require(self.deleted is None or (self.mode == SCD1 and self.cursor), "Delete flags need SCD1 with a cursor")

    @property
    def cursor_column(self) -> str | None:
        return self.cursor and self.contract.by_source(self.cursor).output

    def mark(self, version: Version | None) -> SparkColumn | None:
        """High-water mark stored with the last committed version."""
        text = version.info.get("mark") if version else None
        if text is None:
            return None
        return F.lit(text).cast(spark_type(self.contract.by_source(self.cursor).type))

    def _info(self, previous: Version | None):
        """The next mark comes from the rows that were written, so it never passes unread rows."""
        if not self.cursor:
            return {}
        before = previous.info.get("mark") if previous else None

        def info(written: DataFrame) -> dict:
            highest = history.high_water_mark(written, self.cursor_column).select(F.col("high_water_mark").cast("string"))
            found = highest.first()[0]
            if None not in (before, found):
                # Rows of untouched buckets are not among those written, and may hold the highest mark.
                kind = spark_type(self.contract.by_source(self.cursor).type)
                both = written.sparkSession.range(1).select(F.greatest(*[F.lit(m).cast(kind) for m in (before, found)]).cast("string"))
                found = both.first()[0]
            mark = {"mark": before if found is None else found}
            return mark if self.mode == APPEND_ONLY else {**mark, "buckets": self.buckets}

        return info

    def run(self, spark: SparkSession) -> Version:
        target = Dataset(spark, self.target)
        previous = target.version()
        rows = self._accepted(self.source(spark, self.mark(previous)))
        if self.cursor:
            rows = history.after_cursor(rows, self.cursor_column, self.mark(previous))
        keys = self.contract.keys
        info = self._info(previous)
        if self.mode == APPEND_ONLY:
            if not self.cursor:
                return target.replace_table(rows, info)
            return target.add_to_table(rows, info)
        if self.cursor:
            return self._increment(target, previous, rows, info)
        if self.mode == SCD1:
            return target.replace_table(rows, info)
        opened = target.frame(previous, target.parts(previous, OPEN)) if previous else None
        number = previous.number + 1 if previous else 1
        return target.advance_history(history.advance_snapshot(opened, rows, keys, number), info)

    def _bucket(self) -> SparkColumn:
        return F.pmod(F.xxhash64(*[name(k) for k in self.contract.keys]), F.lit(self.buckets)).cast("int")

    def _increment(self, target: Dataset, previous: Version | None, rows: DataFrame, info) -> Version:
        """Apply newer rows to the buckets that they fall into; without any, the version stays."""
        keys, role = self.contract.keys, TABLE if self.mode == SCD1 else OPEN
        rows = checkpoint(rows)  # the source is read once
        touched = sorted(r[0] for r in rows.select(self._bucket().alias(BUCKET)).distinct().collect())
        if previous is None:
            stored, touched = None, None
        elif not touched:
            return previous
        else:
            same = previous.info.get("buckets", self.buckets) == self.buckets
            require(same, "The number of buckets is fixed when a target is created")
            if any(p.bucket is None for p in target.parts(previous, role)):
                touched = None  # written before the table was kept in buckets
            stored = target.frame(previous, target.parts(previous, role, buckets=touched))
        if self.mode == SCD1:
            fresh = history.scd1_merge(stored, rows, keys, self.cursor_column, self.deleted)
        else:
            fresh = advance_by_cursor(stored, rows, keys, self.cursor_column)
        return target.replace_buckets(fresh, self._bucket(), touched, info)

    def _accepted(self, rows: DataFrame) -> DataFrame:
        """The source's rows in the contract's column order, refused when their columns, types or keys are not the contract's."""
        wanted = {c.output: spark_type(c.type) for c in self.contract.columns}
        found = [(f.name, f.dataType) for f in rows.schema.fields]
        require(len(found) == len(wanted) and dict(found) == wanted, "The source's columns or types differ from the contract", DataRejected)
        rows = rows.select(*[name(c) for c in wanted])
        if not self.cursor and self.mode != APPEND_ONLY:
            # A full refresh has each key once; a cursor may bring several versions of one.
            repeated = duplicate_keys(rows, self.contract.keys).count()
            require(not repeated, f"{repeated} keys occur more than once in a full refresh", DataRejected)
        return rows

    def check(self, spark: SparkSession) -> list:
        """All contract rules on the committed version."""
        rules = compile_rules(self.contract, MANAGED, self.unsupported)
        target = Dataset(spark, self.target)
        return after_load(target, self.contract.published(), rules, self.mode == SCD2, self.results)


def advance_by_cursor(opened: DataFrame | None, rows: DataFrame, keys: list[str], cursor: str) -> DataFrame:
    """Open rows, and rows closed by newer source rows; versions start at the cursor value.

    A source row that differs in nothing but its cursor does not open a version.
    """
    tracked = [c for c in rows.columns if c not in {*keys, cursor}]
    events = rows.withColumn("__cf_at", name(cursor))
    if opened is None:
        return history.scd2_from_events(events, keys, "__cf_at", tracked=tracked)
    changed = rows.select(*[name(k) for k in keys]).distinct()
    before = opened.join(changed, keys, "left_semi").withColumn("__cf_at", name(START_AT)).drop(START_AT, END_AT)
    moved = history.scd2_from_events(before.unionByName(events), keys, "__cf_at", tracked=tracked)
    # Rows of keys without news are as they were; only the others are ordered.
    return moved.unionByName(opened.join(changed, keys, "left_anti").select(*moved.columns))
