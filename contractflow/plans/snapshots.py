"""Complete versioned snapshots to an SCD2 history and a current table."""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..errors import DataRejected, listed, require
from ..functions.rules import SNAPSHOT, Check, compile_rules
from ..operators import history, ledger, quality
from ..operators.ledger import Policy
from ..operators.projection import TEMPORAL_FLAG, business_rules, preflight_parquet, project, required_rules
from ..sources.datasets import OPEN, Dataset, Version, result_store
from ..sources.files import read_snapshot, reader_options, without_values
from ..sources.ledgers import API_VERSION, dataset_ledger
from .publication import latest_index
from .terms import SourceTerms

UNREADABLE = "The snapshot does not match its declared schema"
STRUCTURE = "structure:"


@dataclass(frozen=True)
class SnapshotFlow:
    """Apply a dataset's deliveries strictly in version order, one per step.

    Keys, tracked and freshness columns are physical source names. ``index`` is an index file, or
    the folder of published indexes, of which the current one is read. ``results`` is a dataset
    that keeps every rule's result.
    """

    dataset: str
    contract: Contract
    source_root: str
    index: str
    target: str
    fmt: str = "parquet"
    reader: Mapping | None = None
    keys: Sequence[str] | None = None
    tracked: Sequence[str] | None = None
    expectations: Mapping[str, str] | None = None
    policy: Policy = field(default_factory=Policy)
    terms: SourceTerms | None = None
    freshness: tuple[str, float] | None = None
    unsupported: str = "error"
    results: str | None = None
    api_version: str = API_VERSION

    def __post_init__(self):
        require(isinstance(self.contract.version, str), "Snapshots need a contract version")
        require(self.key_columns, "Declare keys in the flow or the contract")
        require(self.index.startswith(self.source_root + "/"), "The delivery index is inside the source root")
        reader_options(self.fmt, self.reader, SNAPSHOT)
        require(self.fmt in ("json", "parquet"), "Snapshots are JSON or Parquet")
        self.contract.resolve(self.tracked)
        self.checks()
        if self.terms:
            self.terms.check(SNAPSHOT)
        if self.freshness:
            require(self.contract.by_source(self.freshness[0]).temporal, "Freshness needs a DATE or TIMESTAMP column")

    def checks(self) -> list:
        return compile_rules(self.contract, SNAPSHOT, self.unsupported)

    @property
    def key_columns(self) -> list[str]:
        return self.contract.keys if self.keys is None else self.contract.resolve(self.keys)

    @property
    def tracked_columns(self) -> list[str] | None:
        return None if self.tracked is None else self.contract.resolve(self.tracked)

    def receipts(self, spark: SparkSession) -> DataFrame:
        index = self.index if self.index.endswith(".json") else latest_index(spark, self.index)
        return dataset_ledger(spark, index, self.dataset, self.api_version)

    def next_delivery(self, spark: SparkSession, latest: int | None, now: dt.datetime | None = None):
        """The delivery after ``latest``, or None when caught up; every receipt is checked first."""
        receipts = self.receipts(spark)
        found = ledger.receipt_violations(receipts, self.source_root)
        found = found.unionByName(ledger.duplicate_violations(receipts))
        found = found.unionByName(ledger.stale_violations(receipts, self.policy, now))
        ledger.enforce(found)
        waiting = ledger.pending(receipts, latest).take(1)
        if not waiting:
            return None
        delivery = waiting[0]
        here = receipts.where(F.col("version") == delivery.version)
        broken = ledger.contract_violations(here, self.contract.version)
        broken = broken.unionByName(ledger.policy_violations(here, self.policy))
        ledger.enforce(broken)
        if latest is not None and self.policy.maximum_drop_percent is not None:
            before = receipts.where(F.col("version") == latest).select("row_count").take(1)
            require(before, "The row-count drop cannot be judged without the previous delivery's receipt", DataRejected)
            rows = before[0].row_count
            drop = 100 * (rows - delivery.row_count) / rows if rows else 0
            require(drop <= self.policy.maximum_drop_percent, "Too many rows disappeared since the previous delivery", DataRejected)
        return delivery

    def verified(self, spark: SparkSession, delivery) -> DataFrame:
        """The delivered rows in contract columns, after every structural and quality check."""
        if self.fmt == "parquet":
            preflight_parquet(spark, delivery.path, self.contract)
        options = reader_options(self.fmt, self.reader, SNAPSHOT)
        checks = self.checks()
        queries = [c for c in checks if c.metric == "sql"]
        with without_values(UNREADABLE):
            source = read_snapshot(spark, delivery.path, self.contract, self.fmt, options)
            flagged = project(source, self.contract, self.fmt, on_invalid="report")
            judged = self._judge(flagged, [c for c in checks if c.metric != "sql"], delivery)
            rows = project(source, self.contract, self.fmt)
            judged += quality.evaluate(rows, queries).collect() if queries else []
        place = {c.id: n for n, c in enumerate(checks)}
        judged.sort(key=lambda r: place[r.id])
        context = {"dataset": self.dataset, "delivery": str(delivery.version)}
        quality.enforce_rows(spark, judged, quality.BEFORE_LOAD, result_store(spark, self.results), context)
        return rows

    def _judge(self, flagged: DataFrame, checks: list[Check], delivery) -> list:
        """Structural rules and counted quality rules from one job: all row rules share one scan,
        key uniqueness reads only the keys. Bad rows are never dropped: a missing row would become
        a delete."""
        structure = {TEMPORAL_FLAG: ~F.col(TEMPORAL_FLAG)}
        structure.update(required_rules(self.contract, self.key_columns))
        structure.update(business_rules(self.expectations))
        own = [Check(STRUCTURE + rule, "predicate", predicate=holds) for rule, holds in structure.items()]
        own.append(Check(STRUCTURE + "rows", "rowCount", threshold=delivery.row_count))
        own.append(Check(STRUCTURE + "keys", "duplicateValues", properties=tuple(self.key_columns)))
        results = quality.evaluate(flagged, own + checks).collect()
        failing = {r.id[len(STRUCTURE) :]: r.value for r in results if r.id.startswith(STRUCTURE) and not r.passed}
        reject = lambda ok, message: require(ok, message, DataRejected)
        reject(failing.pop(TEMPORAL_FLAG, None) is None, "A temporal value is not an exact date or zone-less timestamp")
        reject(failing.pop("rows", None) is None, "The row count differs from the delivery")
        repeated = failing.pop("keys", None)
        failed = [f"{rule} ({n})" for rule, n in failing.items()]
        reject(not failed, f"Row rules failed, no rows were discarded: {listed(failed)}")
        reject(repeated is None, "Some snapshot keys occur more than once")
        return [r for r in results if not r.id.startswith(STRUCTURE)]

    def apply_next(self, spark: SparkSession, now: dt.datetime | None = None) -> Version | None:
        """Apply the next delivery and commit it, or do nothing when caught up."""
        target = Dataset(spark, self.target)
        previous = target.version()
        latest = previous.info["delivery"] if previous else None
        delivery = self.next_delivery(spark, latest, now)
        if delivery is None:
            return None
        rows = self.verified(spark, delivery)
        opened = target.frame(previous, target.parts(previous, OPEN)) if previous else None
        changed = history.advance_snapshot(opened, rows, self.key_columns, delivery.version, self.tracked_columns)
        # The checks read only their own columns; a malformed JSON value elsewhere fails here.
        hidden = without_values(UNREADABLE) if self.fmt == "json" else contextlib.nullcontext()
        with hidden:
            return target.advance_history(changed, {"delivery": delivery.version, "delivery_id": delivery.id})

    def catch_up(self, spark: SparkSession, now: dt.datetime | None = None) -> int:
        """Apply every pending delivery; returns how many were applied."""
        applied = 0
        while self.apply_next(spark, now):
            applied += 1
        return applied

    def check_fresh(self, spark: SparkSession, now: dt.datetime | None = None) -> None:
        """Refuse when the current rows are too old, or there are none."""
        column, hours = self.freshness
        current = Dataset(spark, self.target).read()
        quality.require_fresh(current, self.contract.by_source(column).output, hours, now)

    def rebuild(self, spark: SparkSession, location: str, deliveries_per_step: int = 50) -> Dataset:
        """History rebuilt from the retained deliveries that the target has applied, into an isolated dataset, to
        be compared with the target before promotion. Every delivery passes all checks again; each step then
        applies many of them in one shuffle."""
        isolated, applied = Dataset(spark, location), Dataset(spark, self.target).version()
        require(isolated.version() is None, "A history is rebuilt into an empty location")
        receipts = self.receipts(spark)
        if applied:
            receipts = receipts.where(F.col("version") <= applied.info["delivery"])
        broken = ledger.receipt_violations(receipts, self.source_root).unionByName(ledger.duplicate_violations(receipts))
        ledger.enforce(broken.unionByName(ledger.contract_violations(receipts, self.contract.version)))
        deliveries = receipts.orderBy("version").collect()
        for start in range(0, len(deliveries), deliveries_per_step):
            series = [(d.version, self.verified(spark, d)) for d in deliveries[start : start + deliveries_per_step]]
            before = isolated.version()
            opened = isolated.frame(before, isolated.parts(before, OPEN)) if before else None
            rows = history.scd2_from_snapshot_series(series, self.key_columns, self.tracked_columns, opened)
            isolated.advance_history(rows, {"delivery": series[-1][0]})
        return isolated


def from_published(flow_contract: Contract, upstream: Contract, dataset: str, index: str, root: str, **settings) -> SnapshotFlow:
    """A flow over snapshots that another flow published. Both contracts must agree, and the
    index names the upstream dataset."""
    require(flow_contract.same_shape(upstream), "The published contract differs from this flow's input contract")
    return SnapshotFlow(dataset=dataset, contract=flow_contract, source_root=root, index=index, **settings)
