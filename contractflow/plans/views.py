"""Materialised views: typed results of SQL or Python over declared inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..contract import Contract
from ..errors import ContractError, require
from ..functions.relations import require_declared
from ..functions.rules import VIEW, Check, compile_rules
from ..operators import quality
from ..operators.projection import conforms
from ..sources.datasets import Dataset, Version, result_store

def _isolated(spark: SparkSession) -> SparkSession:
    """A session with the same settings that sees only the views registered in it."""
    session = spark.newSession()
    for row in spark.sql("SET").collect():
        if row.key.startswith("spark.sql.") and spark.conf.isModifiable(row.key):
            session.conf.set(row.key, row.value)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def _checked_query(spark: SparkSession, query: str, inputs: Sequence[str]) -> str:
    require(isinstance(query, str) and query.strip(), "A view needs a query")
    text = query.strip().rstrip(";")
    require_declared(spark, text, inputs)
    return text


def sql_view(spark: SparkSession, query: str, inputs: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """Result of one query over the declared inputs, labelled by position from the contract."""
    require(inputs, "A view declares its inputs")
    require(len({a.lower() for a in inputs}) == len(inputs), "Input names are distinct")
    require(contract.columns, "A view has typed columns")
    session, shared = _isolated(spark), []
    text = _checked_query(session, query, list(inputs))
    try:
        for alias, frame in inputs.items():
            handle = "input_" + uuid.uuid4().hex
            frame.createGlobalTempView(handle)
            shared.append(handle)
            session.table(f"global_temp.{handle}").createOrReplaceTempView(alias)
        # Inside parentheses only a query parses; a command would be a syntax error.
        result = session.sql(f"SELECT * FROM (\n{text}\n)")
    finally:
        for handle in shared:
            spark.catalog.dropGlobalTempView(handle)
    require(len(result.columns) == len(contract.columns), "The query returns another number of columns")
    return _typed(result.toDF(*contract.names), contract)


def python_view(
    function: Callable[[dict[str, DataFrame]], DataFrame], inputs: Mapping[str, DataFrame], contract: Contract
) -> DataFrame:
    """Result of a user function of named inputs; it must be a batch frame of the contract's type."""
    require(contract.columns, "A view has typed columns")
    result = function(dict(inputs))
    require(isinstance(result, DataFrame) and not result.isStreaming, "A view function returns a batch DataFrame")
    return _typed(result, contract)


def _typed(result: DataFrame, contract: Contract) -> DataFrame:
    if not conforms(result.schema, contract):
        raise ContractError("The view's columns or types differ from its contract")
    return result


def after_load(
    target: Dataset, contract: Contract, checks: Sequence[Check], history: bool = False, results: str | None = None
) -> list:
    """Judge one committed version; a required failure raises but does not roll back."""
    frame, number = target.read_pinned("history" if history else "current")
    judged = quality.check_table(frame, contract, checks, history)
    context = {"target": target.root, "version": str(number)}
    return quality.enforce(judged, quality.AFTER_LOAD, result_store(target.spark, results), context)


def materialize(
    spark: SparkSession,
    frame: DataFrame,
    target: str,
    contract: Contract,
    unsupported: str = "error",
    results: str | None = None,
    info: Mapping | None = None,
) -> Version:
    """Replace the view as a whole, then check the committed version with all its rules."""
    checks = compile_rules(contract, VIEW, unsupported)
    dataset = Dataset(spark, target)
    version = dataset.replace_table(_typed(frame, contract), info)
    after_load(dataset, contract, checks, results=results)
    return version
