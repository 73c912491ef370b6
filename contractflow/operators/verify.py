"""Row checks of a complete snapshot before it may be published or applied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, canonical_type, report_name, spark_type
from ..errors import DataRejected, require
from .ledger import MAX_INTEGER
from .projection import name


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, counted before the shuffle."""
    return df.groupBy(*[name(k) for k in keys]).agg(F.count(F.lit(1)).alias("__cf_n")).where("__cf_n > 1").withColumnRenamed("__cf_n", report_name("rows", keys))


def _expected(contract: Contract, zoned_timestamps: bool) -> list[tuple[str, T.DataType]]:
    def kind(column):
        zoned = zoned_timestamps and canonical_type(column.type) == "TIMESTAMP"
        return T.TimestampType() if zoned else spark_type(column.type)

    return [(c.output, kind(c)) for c in contract.columns]


def verify_snapshot(
    df: DataFrame,
    contract: Contract,
    expected_count: int,
    keys: Sequence[str] | None = None,
    allow_empty: bool = False,
    zoned_timestamps: bool = False,
) -> None:
    """Schema, row count, required values and key uniqueness from one scan and one grouping."""
    reject = lambda ok, message: require(ok, message, DataRejected)
    keys = contract.keys if keys is None else list(keys)
    found = [(f.name, f.dataType) for f in df.schema.fields]
    reject(found == _expected(contract, zoned_timestamps), "The landed columns do not have the contract's names, order and types")
    counted = isinstance(expected_count, int) and not isinstance(expected_count, bool)
    reject(counted and 0 <= expected_count <= MAX_INTEGER, "The expected row count is not a whole number in range")
    reject(expected_count > 0 or allow_empty, "An empty snapshot was not allowed by its policy")
    missing = F.lit(False)
    for column in dict.fromkeys([*contract.required, *keys]):
        missing = missing | name(column).isNull()
    groups = df.groupBy(*[name(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__cf_n"), F.count_if(missing).alias("__cf_missing")
    )
    totals = groups.agg(
        F.coalesce(F.sum("__cf_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("__cf_missing"), F.lit(0)).alias("missing"),
        F.count_if(F.col("__cf_n") > 1).alias("repeated"),
    ).first()
    reject(totals.rows == expected_count, "The landed rows are more or fewer than expected")
    reject(totals.missing == 0, "Some required or key values are missing")
    reject(totals.repeated == 0, "Some snapshot keys occur more than once")
