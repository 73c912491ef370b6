"""Database tables and landed extracts, read with a cursor."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, canonical_type, spark_type
from ..errors import DataRejected, require
from ..operators.history import after_cursor
from ..operators.projection import name


def read_extract(df: DataFrame, contract: Contract) -> DataFrame:
    """Only the contract's columns of a source object, in contract order and under source names."""
    require(all(c.output == c.name for c in contract.columns), "Extracts keep their source field names")
    return df.select(*[name(c.name) for c in contract.columns])


def _check_types(df: DataFrame, contract: Contract) -> None:
    found = {f.name.lower(): f.dataType for f in df.schema.fields}
    for column in contract.columns:
        observed = found.get(column.name.lower())
        require(observed is not None, f"The source has no column {column.name}", DataRejected)
        same = observed == spark_type(column.type)
        text = isinstance(observed, (T.VarcharType, T.CharType)) and canonical_type(column.type) == "STRING"
        require(same or text, f"The source type of {column.name} differs from the contract", DataRejected)


def read_query(
    spark: SparkSession,
    url: str,
    table: str,
    contract: Contract,
    cursor: str | None = None,
    mark=None,
    partition: Mapping | None = None,
    properties: Mapping | None = None,
) -> DataFrame:
    """Rows of a database table beyond the cursor's high-water mark.

    Without a cursor the whole table is read each time. ``partition`` has column, lower, upper
    and count; without it one task reads the table. Column selection and the cursor filter are
    pushed into the database query.
    """
    require(cursor is None or contract.by_source(cursor), "Unknown cursor column")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, preferTimestampNTZ=True)
    reader = reader.options(**(properties or {}))
    if partition:
        require(set(partition) == {"column", "lower", "upper", "count"}, "partition has column, lower, upper and count")
        reader = reader.options(
            partitionColumn=partition["column"],
            lowerBound=partition["lower"],
            upperBound=partition["upper"],
            numPartitions=partition["count"],
        )
    return checked_rows(reader.load(), contract, cursor, mark)


def checked_rows(loaded: DataFrame, contract: Contract, cursor: str | None = None, mark=None) -> DataFrame:
    """Contract columns of a loaded table whose types agree with the contract, beyond the mark."""
    _check_types(loaded, contract)
    chosen = loaded.select(*[F.col(f"`{c.name}`").alias(c.output) for c in contract.columns])
    return chosen if cursor is None else after_cursor(chosen, contract.by_source(cursor).output, mark)
