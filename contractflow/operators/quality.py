"""Quality evaluation over a whole dataset: counts only, never row values."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, spark_type
from ..errors import DataRejected, QualityFailed, listed, require
from ..functions.relations import require_declared
from ..functions.rules import Check, compare
from .projection import current_rows, fails, name

BEFORE_LOAD, AFTER_LOAD = "before-load", "after-load"
RESULT = "id string, outcome string, value string, passed boolean"
METRIC = "decimal(28,4)"


def _metric(check: Check, value: SparkColumn, rows: SparkColumn) -> SparkColumn:
    """The rule's value: a count, or a percentage of all rows with four digits."""
    if check.unit == "percent" and check.metric != "rowCount":
        share = F.round(F.lit(100.0) * value / F.nullif(rows, F.lit(0)), 4)
        value = F.coalesce(share, F.lit(0.0))
    return value.cast(METRIC)


def _result(check: Check, value: SparkColumn, rows: SparkColumn) -> SparkColumn:
    metric = _metric(check, value, rows)
    return F.struct(
        F.lit(check.id).alias("id"),
        F.lit(check.outcome).alias("outcome"),
        F.regexp_replace(metric.cast("string"), r"[.]?0+$", "").alias("value"),
        compare(metric, check.operator, check.threshold).alias("passed"),
    )


def _row_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row rules and the row count in one aggregate; rows are not shuffled."""
    counters = [F.count(F.lit(1)).alias("rows")]
    results = []
    for i, check in enumerate(checks):
        value = F.col("rows")
        if check.row_level:
            counters.append(F.count_if(fails(check.predicate)).alias(f"c{i}"))
            value = F.col(f"c{i}")
        results.append(_result(check, value, F.col("rows")))
    return df.agg(*counters).select(F.inline(F.array(*results)))


def _duplicate_result(df: DataFrame, check: Check) -> DataFrame:
    """Surplus rows per group. Groups are counted before the shuffle; NULLs compare equal in a
    composite rule and are left out of a column rule."""
    columns = [check.column] if check.column else list(check.properties)
    groups = df.groupBy(*[name(c) for c in columns]).agg(F.count(F.lit(1)).alias("__cf_n"))
    counted = name(check.column).isNotNull() if check.column else F.lit(True)
    totals = groups.agg(
        F.coalesce(F.sum(F.when(counted, F.col("__cf_n") - 1)), F.lit(0)).alias("surplus"),
        F.coalesce(F.sum("__cf_n"), F.lit(0)).alias("rows"),
    )
    return totals.select(F.inline(F.array(_result(check, F.col("surplus"), F.col("rows")))))


def _duplicate_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All duplicate rules from one scan: every rule's columns are a grouping set, groups of all sets are counted before one shuffle.

    NULLs compare equal in a composite rule and are left out of a column rule, also where both have the same single column.
    """
    columns = {c.id: (c.column,) if c.column else tuple(dict.fromkeys(c.properties)) for c in checks}
    every = list(dict.fromkeys(itertools.chain.from_iterable(columns.values())))
    sets = list({frozenset(chosen): [name(c) for c in chosen] for chosen in columns.values()}.values())
    groups = df.groupingSets(sets, *[name(c) for c in every]).agg(F.count(F.lit(1)).alias("__cf_n"), F.grouping_id().alias("__cf_set"))
    number = lambda chosen: sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in chosen)  # a bit for each column left out
    totals, results = [], []
    for i, check in enumerate(checks):
        mine = F.col("__cf_set") == number(columns[check.id])
        counted = mine & name(check.column).isNotNull() if check.column else mine
        total = lambda which, value: F.coalesce(F.sum(F.when(which, value)), F.lit(0))
        totals += [total(counted, F.col("__cf_n") - 1).alias(f"surplus{i}"), total(mine, F.col("__cf_n")).alias(f"rows{i}")]
        results.append(_result(check, F.col(f"surplus{i}"), F.col(f"rows{i}")))
    return groups.agg(*totals).select(F.inline(F.array(*results)))


def _sql_result(df: DataFrame, check: Check) -> DataFrame:
    """One numeric value of a read-only query over the data."""
    view = "data_" + uuid.uuid4().hex
    query = check.query.replace("${table}", view)
    require_declared(df.sparkSession, query, [view])
    df.createOrReplaceTempView(view)
    try:
        answer = df.sparkSession.sql(query)
    finally:
        df.sparkSession.catalog.dropTempView(view)
    message = f"A SQL rule returns one finite numeric value: {check.id}"
    fields = answer.schema.fields
    require(len(fields) == 1 and isinstance(fields[0].dataType, T.NumericType), message, DataRejected)
    exact = not isinstance(fields[0].dataType, (T.DoubleType, T.FloatType))
    answer = answer.toDF("__cf_v").limit(2)
    one = answer.agg(F.count(F.lit(1)).alias("n"), F.max("__cf_v").alias("v"))
    usable = (F.col("n") == 1) & F.col("v").isNotNull()
    if not exact:
        usable = usable & ~F.isnan("v") & (F.abs("v") != float("inf"))
    value = F.when(~usable, F.raise_error(F.lit(message)).cast(fields[0].dataType)).otherwise(F.col("v"))
    return one.select(value.alias("v")).select(
        F.lit(check.id).alias("id"),
        F.lit(check.outcome).alias("outcome"),
        F.col("v").cast("string").alias("value"),
        compare(F.col("v"), check.operator, check.threshold, exact).alias("passed"),
    )


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(id, outcome, value, passed) of every check, as one lazy result.

    Row rules share one scan and one aggregate; so do duplicate rules, which read only their columns.
    """
    single = [c for c in checks if c.row_level or c.metric == "rowCount"]
    parts = [_row_results(df, single)] if single else []
    repeated = [c for c in checks if c.metric == "duplicateValues"]
    parts += [_duplicate_results(df, repeated)] if len(repeated) > 1 else [_duplicate_result(df, c) for c in repeated]
    parts += [_sql_result(df, c) for c in checks if c.metric == "sql"]
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quality_results(results: DataFrame, context: Mapping[str, str], enforcement: str) -> DataFrame:
    """Result rows as stored: rule, outcome, value, verdict, context and boundary."""
    require(enforcement in (BEFORE_LOAD, AFTER_LOAD), "Unknown enforcement boundary")
    pairs = [F.lit(part) for item in context.items() for part in item]
    context_map = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return results.withColumn("context", context_map).withColumn("enforcement", F.lit(enforcement))


def enforce(
    results: DataFrame,
    enforcement: str = AFTER_LOAD,
    store: Callable[[DataFrame], None] | None = None,
    context: Mapping[str, str] | None = None,
) -> list[Row]:
    """Collect one row per rule and refuse the data if a required rule failed.

    ``store`` receives the result rows, also those of a refused dataset.
    """
    rows = results.select("id", "outcome", "value", "passed").collect()
    return enforce_rows(results.sparkSession, rows, enforcement, store, context)


def enforce_rows(spark: SparkSession, rows: Sequence[Row], enforcement: str, store=None, context=None) -> list[Row]:
    require(enforcement in (BEFORE_LOAD, AFTER_LOAD), "Unknown enforcement boundary")
    if store:
        store(quality_results(spark.createDataFrame(list(rows), RESULT), context or {}, enforcement))
    failed = [r.id for r in rows if r.outcome == "fail" and not r.passed]
    if failed:
        told = (
            "Quality rules failed, the snapshot was not applied: "
            if enforcement == BEFORE_LOAD
            else "Quality failed after load, committed data and checkpoint stay as they are: "
        )
        raise QualityFailed(told + listed(failed))
    return list(rows)


def check_table(df: DataFrame, contract: Contract, checks: Sequence[Check], history: bool = False) -> DataFrame:
    """Structure, required values and rules of one committed table version.

    For SCD2 tables only current rows are judged. Returns the rule results.
    """
    missing = [c for c in contract.names if c not in df.columns]
    require(not missing, "The table lacks declared contract columns", DataRejected)
    rows = current_rows(df) if history else df
    types = {f.name: f.dataType for f in df.schema.fields}
    differing = [c.output for c in contract.columns if types[c.output] != spark_type(c.type)]
    require(not differing, "Column types differ from the contract", DataRejected)
    empty = [name(c).isNull() for c in contract.required]
    if empty:
        condition = empty[0]
        for item in empty[1:]:
            condition = condition | item
        require(rows.where(condition).isEmpty(), "Required values are missing after load", DataRejected)
    return evaluate(rows, checks)


def _utc(now: dt.datetime | None) -> dt.datetime:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone.utc).replace(tzinfo=None) if now.tzinfo else now


def fresh(df: DataFrame, column: str, hours: float, now: dt.datetime | None = None) -> DataFrame:
    """Whether the latest value is recent enough. No rows means not fresh.

    Zone-less values are read as UTC; a DATE counts from its midnight.
    """
    kind = df.schema[column].dataType
    require(isinstance(kind, (T.DateType, T.TimestampNTZType)), "Freshness needs a DATE or TIMESTAMP column")
    oldest = _utc(now) - dt.timedelta(seconds=math.ceil(hours * 3600))
    latest = F.max(name(column)).alias("latest")
    limit = F.lit(oldest.isoformat(sep=" ")).cast("timestamp_ntz")
    is_fresh = F.coalesce(F.col("latest").cast("timestamp_ntz") >= limit, F.lit(False))
    return df.agg(latest).select("latest", is_fresh.alias("fresh"))


def require_fresh(df: DataFrame, column: str, hours: float, now: dt.datetime | None = None) -> None:
    require(fresh(df, column, hours, now).first().fresh, "The newest value is too old, or there is none", DataRejected)
