"""Source rows to contract rows: one simultaneous, type-preserving projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import END_AT, RESCUED, Contract, spark_type
from ..errors import ContractError, DataRejected, listed, require
from ..functions import temporal

TEMPORAL_FLAG = "__cf_temporal_invalid"


def name(text: str) -> SparkColumn:
    return F.col(f"`{text}`")


def literal(value, kind: T.DataType) -> SparkColumn:
    """A value as a literal of a column's type. Going through text keeps a timestamp without a
    zone as it is; a plain literal would shift it by the session's time zone."""
    if isinstance(value, SparkColumn):
        return value
    return F.lit(None if value is None else str(value)).cast(kind)


def project(
    df: DataFrame,
    contract: Contract,
    fmt: str = "parquet",
    on_invalid: str = "raise",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Rename physical to published columns in one select, so swapped names keep their values.

    ``on_invalid="raise"`` fails the query on a malformed temporal value, ``"report"`` adds a
    boolean column instead so that a caller can count bad rows in its own pass.
    """
    require(on_invalid in ("raise", "report"), "on_invalid is raise or report")
    text = fmt != "parquet"
    columns = []
    for column in contract.columns:
        value = name(column.name)
        if column.temporal and text:
            convert = temporal.parse_or_fail if on_invalid == "raise" else temporal.parse
            value = convert(value, column.type)
        columns.append(value.alias(column.output))
    if RESCUED in df.columns:
        columns.append(name(RESCUED))
    columns += [name(c) for c in keep]
    if on_invalid == "report":
        columns.append(temporal.any_invalid(contract, fmt).alias(TEMPORAL_FLAG))
    return df.select(*columns)


def preflight_parquet(spark: SparkSession, path, contract: Contract) -> None:
    """Compare the merged footer schema of every file with the contract's temporal types.

    A forced read schema would silently reinterpret a zoned timestamp, so footers come first.
    """
    if not any(c.temporal for c in contract.columns):
        return
    paths = [path] if isinstance(path, str) else list(path)
    message = "A Parquet temporal column differs from the contract in type, time zone or precision"
    try:
        observed = spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except Exception as error:
        raise DataRejected(message) from error
    found = {f.name: f.dataType for f in observed.fields}
    for column in contract.columns:
        if column.temporal and found.get(column.name) != spark_type(column.type):
            raise DataRejected(message)


def required_rules(
    contract: Contract, keys: Iterable[str], sequence: Iterable[str] = (), operation: str | None = None
) -> dict[str, SparkColumn]:
    """Named predicates that hold where a required, key or sequence column has a value.

    On events, a requirement on any other column is waived for deletes.
    """
    always = set(keys) | set(sequence)
    ordered = list(dict.fromkeys([*contract.required, *keys, *sequence]))
    rules = {}
    for column in ordered:
        holds = name(column).isNotNull()
        if operation and column not in always:
            holds = (name(operation) == "D") | holds
        rules[f"required.{column}"] = holds
    return rules


def business_rules(expectations: Mapping[str, str] | None) -> dict[str, SparkColumn]:
    """Named SQL predicates; unlike required columns they are never waived for deletes."""
    rules = {}
    for rule, text in (expectations or {}).items():
        require(rule.isidentifier(), f"Invalid expectation name {rule}")
        require(
            isinstance(text, str) and text.strip() and not any(mark in text for mark in (";", "--", "/*")),
            "An expectation is one SQL predicate without comments or statements",
        )
        rules[f"business.{rule}"] = F.expr(text)
    return rules


def fails(rule: SparkColumn) -> SparkColumn:
    """A rule that is NULL counts as failing."""
    return ~F.coalesce(rule, F.lit(False))


def invalid(rules: Mapping[str, SparkColumn]) -> SparkColumn:
    """One predicate for all rules, true where any of them fails."""
    condition = F.lit(False)
    for rule in rules.values():
        condition = condition | fails(rule)
    return condition


def row_violations(
    df: DataFrame,
    contract: Contract,
    keys: Iterable[str] | None = None,
    expectations: Mapping[str, str] | None = None,
    sequence: Iterable[str] = (),
    operation: str | None = None,
) -> DataFrame:
    """Failing-row count of every row rule, from one aggregate over the data."""
    rules = required_rules(contract, contract.keys if keys is None else keys, sequence, operation)
    rules.update(business_rules(expectations))
    if operation:
        rules["operation"] = name(operation).isin("I", "U", "D")
    if RESCUED in df.columns:
        rules["source_schema"] = name(RESCUED).isNull()
    return count_failures(df, rules)


def count_failures(df: DataFrame, rules: Mapping[str, SparkColumn]) -> DataFrame:
    """(rule, violations) rows for the given named predicates; one pass, no shuffle of rows."""
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, violations bigint")
    counters = [F.count_if(fails(rule)).alias(f"c{i}") for i, rule in enumerate(rules.values())]
    pairs = [F.struct(F.lit(rule).alias("rule"), name(f"c{i}").alias("violations")) for i, rule in enumerate(rules)]
    return df.agg(*counters).select(F.inline(F.array(*pairs)))


def require_valid(df: DataFrame, contract: Contract, **settings) -> None:
    """Refuse data with any failing row; rows are never dropped."""
    failed = [r for r in row_violations(df, contract, **settings).collect() if r.violations]
    if failed:
        told = listed(f"{r.rule} ({r.violations})" for r in failed)
        raise DataRejected(f"Row rules failed, no rows were discarded: {told}")


def business_columns(df: DataFrame, contract: Contract, drop: Iterable[str] = ()) -> DataFrame:
    """Contract columns in contract order, without operation, sequence and rescue columns."""
    hidden = set(drop)
    return df.select(*[name(c) for c in contract.names if c not in hidden])


def current_rows(history: DataFrame) -> DataFrame:
    """Open rows of a history."""
    if END_AT not in history.columns:
        raise ContractError(f"History has no {END_AT} column; current rows cannot be told apart")
    return history.where(name(END_AT).isNull())


def conforms(schema: T.StructType, contract: Contract) -> bool:
    """Exact names, order and types; implicit casts are never made."""
    return [(f.name, f.dataType) for f in schema.fields] == [(c.output, spark_type(c.type)) for c in contract.columns]
