"""Policy rules over ledgers of immutable snapshot deliveries, for many datasets in one job."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DataRejected, require
from ..session import rows_per_block
from .blocks import PREVIOUS, with_previous

# Limits and forms of the delivery index format.
MAX_INTEGER = 9007199254740991
MAX_RECEIPTS = 10_000
SCOPE = "full-table"
RECEIPT_ID = r"^[A-Za-z0-9_-]{1,128}\z"
CAPTURED_AT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})\z"

VIOLATION = "dataset string, version bigint, rule string, detail string"

# Receipts that one task groups by value, and counters by which large datasets are found.
RECEIPTS_PER_TASK = 250_000
COUNTERS = 65_536


@dataclass(frozen=True)
class Policy:
    """Limits on what a snapshot delivery may change; None means no limit."""

    allow_empty: bool | None = None
    minimum_rows: int | None = None
    maximum_drop_percent: float | None = None
    maximum_age_hours: float | None = None

    def __post_init__(self):
        number = lambda v: v is None or (isinstance(v, (int, float)) and not isinstance(v, bool))
        require(self.minimum_rows is None or (number(self.minimum_rows) and self.minimum_rows >= 0), "Invalid minimumRows")
        drop = self.maximum_drop_percent
        require(number(drop) and (drop is None or 0 <= drop <= 100), "Invalid maximumDropPercent")
        age = self.maximum_age_hours
        require(number(age) and (age is None or age > 0), "Invalid maximumAgeHours")

    def over(self, base: "Policy | None") -> "Policy":
        """This table's policy on top of a flow's policy."""
        if base is None:
            return self
        pick = lambda field: getattr(self, field) if getattr(self, field) is not None else getattr(base, field)
        return Policy(*(pick(f) for f in self.__dataclass_fields__))


def captured(column: str = "captured_at") -> SparkColumn:
    """Instant of an ISO text with an explicit offset; NULL when malformed."""
    text = F.col(column)
    # The cast needs the seconds that the format lets writers leave out.
    whole = F.regexp_replace(text, r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-])", "$1:00$2")
    return F.when(text.rlike(CAPTURED_AT), whole.try_cast("timestamp"))


def _instant(now: dt.datetime | None) -> SparkColumn:
    now = now or dt.datetime.now(dt.timezone.utc)
    require(now.tzinfo is not None, "now needs a time zone")
    return F.lit(now.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def _holds(condition: SparkColumn) -> SparkColumn:
    return F.coalesce(condition, F.lit(False))


def _violations(df: DataFrame, rules: Mapping[str, tuple[SparkColumn, SparkColumn]]) -> DataFrame:
    """One row per broken rule; ``rules`` maps a name to (broken, detail)."""
    found = [
        F.when(broken, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
        for rule, (broken, detail) in rules.items()
    ]
    # Most receipts are sound: a plain filter drops them before any array is built.
    faulty = functools.reduce(lambda a, b: a | b, (broken for broken, _ in rules.values()))
    return df.where(faulty).select("dataset", "version", F.inline(F.array_compact(F.array(*found))))


def inside_root(root: str | SparkColumn, publication: bool) -> SparkColumn:
    """Path below the root without dot segments; for publication exactly one run directory."""
    path, root = F.col("path"), F.lit(root)
    under = F.startswith(path, F.concat(root, F.lit("/")))
    if publication:
        return under & path.substr(F.length(root) + 2, F.length(path)).rlike(RECEIPT_ID)
    return under & ~path.rlike(r"(^|/)[.]{1,2}(/|\z)")


def _receipt_rules(root: str | SparkColumn | None, publication: bool) -> dict:
    first = 1 if publication else 0
    well_formed = {
        "version": F.col("version").between(first, MAX_INTEGER),
        "row_count": F.col("row_count").between(0, MAX_INTEGER),
        "id": F.col("id").rlike(RECEIPT_ID) if publication else F.length("id") > 0,
        "contract_version": F.length("contract_version") > 0,
        "captured_at": captured().isNotNull(),
        "complete": F.col("complete") & (F.col("scope") == SCOPE),
    }
    if root is not None:
        well_formed["path"] = inside_root(root, publication)
    return {rule: (~_holds(ok), F.lit(None)) for rule, ok in well_formed.items()}


def receipt_violations(
    ledger: DataFrame, root: str | SparkColumn | None = None, publication: bool = False
) -> DataFrame:
    """Malformed, partial or misplaced receipts (one row-level pass)."""
    return _violations(ledger, _receipt_rules(root, publication))


def _by_dataset(ledger: DataFrame, columns: list[str], block_rows: int | None) -> list[DataFrame]:
    """The columns, with each dataset's rows in one task, but for datasets too large for one: those stay where they are.

    Rows are counted per hash of the dataset, so what is counted has a fixed size.
    """
    counter = F.pmod(F.xxhash64("dataset"), F.lit(COUNTERS))
    counts = ledger.groupBy(counter.alias("counter")).agg(F.count(F.lit(1)).alias("n"))
    limit = rows_per_block(ledger.sparkSession, block_rows)
    large = F.col("n") > limit
    found = counts.agg(F.sum(F.when(~large, F.col("n"))).alias("rows"), F.collect_list(F.when(large, F.col("counter"))).alias("large")).first()
    lean = ledger.select(*columns)
    tasks = max(1, -(-(found.rows or 0) // RECEIPTS_PER_TASK))
    if not found.large:
        return [lean.repartition(tasks, "dataset")]
    hot = counter.isin(found.large)
    return [lean.where(~hot).repartition(tasks, "dataset"), lean.where(hot)]


def duplicate_violations(ledger: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Ids, versions and paths used more than once within a dataset.

    A receipt is shuffled once, by its dataset, and not once for each field. Only the receipts of datasets too large for a
    task are shuffled by field and value.
    """
    parts = [_duplicates(part) for part in _by_dataset(ledger, ["dataset", "version", "id", "path"], block_rows)]
    return functools.reduce(DataFrame.unionByName, parts)


def _duplicates(ledger: DataFrame) -> DataFrame:
    pair = lambda field: F.struct(F.lit(field).alias("field"), F.col(field).cast("string").alias("value"))
    fields = F.array(pair("id"), pair("version"), pair("path"))
    uses = ledger.select("dataset", "version", F.inline(fields)).groupBy("dataset", "field", "value")
    return (
        uses.agg(F.count(F.lit(1)).alias("n"), F.min("version").alias("version"))
        .where("n > 1")
        .select(
            "dataset",
            "version",
            F.concat(F.lit("duplicate_"), F.col("field")).alias("rule"),
            F.col("n").cast("string").alias("detail"),
        )
    )


def order_violations(
    ledger: DataFrame,
    contiguous: bool = True,
    maximum_drop_percent: float | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Gaps, capture times running backwards, and row-count drops against the previous version.

    Receipts alike in version, capture time and id are taken from the largest row count down, so that reruns agree.
    """
    lean = ledger.select("dataset", "version", "id", captured().alias("captured_at"), "row_count")
    order = ["version", "captured_at", "id", F.desc("row_count")]
    ordered = with_previous(lean, ["dataset"], order, ["version", "captured_at", "row_count"], block_rows)
    before = F.col(PREVIOUS)
    nothing = F.lit(None)
    rules = {"time_order": (_holds(F.col("captured_at") < before["captured_at"]), nothing)}
    if contiguous:
        step = F.coalesce(before["version"], F.lit(0)) + 1
        # A repeated version is a duplicate, not a gap.
        repeated = _holds(before["version"] == F.col("version"))
        rules["gap"] = (_holds(F.col("version") != step) & ~repeated, step)
    if maximum_drop_percent is not None:
        previous = before["row_count"]
        drop = F.lit(100.0) * (previous - F.col("row_count")) / F.nullif(previous, F.lit(0))
        rules["drop_percent"] = (_holds(drop > F.lit(float(maximum_drop_percent))), F.round(drop, 4))
    return _violations(ordered, rules)


def _policy_rules(policy: Policy) -> dict:
    rows = F.col("row_count")
    rules = {"minimum_rows": (_holds(rows < F.lit(policy.minimum_rows or 0)), rows)}
    if not policy.allow_empty:
        rules["empty"] = (_holds(rows == 0), F.lit(None))
    return rules


def policy_violations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Deliveries that are empty or below the minimum size."""
    return _violations(ledger, _policy_rules(policy))


def _datasets(ledger: DataFrame) -> DataFrame:
    """Newest delivery and number of receipts of each dataset."""
    newest = F.max(F.struct("version", captured().alias("at"))).alias("__cf_n")
    sizes = ledger.groupBy("dataset").agg(newest, F.count(F.lit(1)).alias("n"))
    return sizes.select("dataset", F.col("__cf_n.version").alias("version"), F.col("__cf_n.at").alias("at"), "n")


def _age_rules(policy: Policy, now: dt.datetime | None) -> dict:
    age = F.timestamp_diff("MICROSECOND", F.col("at"), _instant(now)) / F.lit(3.6e9)
    rules = {"future": (_holds(age < 0), F.lit(None))}
    if policy.maximum_age_hours is not None:
        rules["stale"] = (_holds(age > F.lit(float(policy.maximum_age_hours))), F.lit(None))
    return rules


def _capacity_rules() -> dict:
    return {"capacity": (F.col("n") > MAX_RECEIPTS, F.col("n"))}


def stale_violations(ledger: DataFrame, policy: Policy, now: dt.datetime | None = None) -> DataFrame:
    """Age of the newest delivery of each dataset, also when there is nothing left to process."""
    return _violations(_datasets(ledger), _age_rules(policy, now))


def capacity_violations(ledger: DataFrame) -> DataFrame:
    """Datasets that retain more receipts than an index may hold."""
    sizes = ledger.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.max("version").alias("version"))
    return _violations(sizes, _capacity_rules())


def audit(
    ledger: DataFrame,
    policy: Policy = Policy(),
    root: str | SparkColumn | None = None,
    publication: bool = True,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Every broken rule of every dataset: (dataset, version, rule, detail).

    Row rules share one pass and dataset rules one grouping.
    """
    parts = [
        _violations(ledger, {**_receipt_rules(root, publication), **_policy_rules(policy)}),
        duplicate_violations(ledger),
        order_violations(ledger, publication, policy.maximum_drop_percent),
        _violations(_datasets(ledger), {**_age_rules(policy, now), **_capacity_rules()}),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def enforce(violations: DataFrame) -> None:
    """Refuse a ledger that breaks a rule, naming every broken rule with its count and first version."""
    found = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.min("version").alias("first")).orderBy("rule").collect()
    if found:
        listed = ", ".join(f"{r.rule} ({r.n}, first at version {r.first})" for r in found)
        raise DataRejected(f"Delivery ledger breaks its rules: {listed}")


def pending(ledger: DataFrame, latest=None) -> DataFrame:
    """The next delivery of each dataset: the lowest version above the latest processed one.

    ``latest`` is a version, None, or a frame of (dataset, latest) with one row per dataset.
    """
    left = ledger
    if isinstance(latest, DataFrame):
        left = ledger.join(latest.select("dataset", "latest"), "dataset", "left")
        left = left.where(F.col("latest").isNull() | (F.col("version") > F.col("latest"))).drop("latest")
    elif latest is not None:
        left = ledger.where(F.col("version") > F.lit(int(latest)))
    rest = [c for c in ledger.columns if c not in ("dataset", "version")]
    first = left.groupBy("dataset").agg(F.min(F.struct("version", *rest)).alias("__cf_next"))
    return first.select("dataset", "__cf_next.*").select(*ledger.columns)


def contract_violations(waiting: DataFrame, contract_version: str) -> DataFrame:
    """Pending deliveries made under another contract; processed ones may differ."""
    differs = ~_holds(F.col("contract_version") == F.lit(contract_version))
    return _violations(waiting, {"contract_mismatch": (differs, F.lit(None))})
