"""Delivery indexes: JSON documents listing a dataset's immutable snapshot deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataRejected, require

API_VERSION = "contractflow.delivery-index/v1"

# The fields of a delivery index and of its receipts.
INDEX_SCHEMA = """
    apiVersion STRING, dataset STRING,
    deliveries ARRAY<STRUCT<
        id: STRING, version: BIGINT, capturedAt: STRING, contractVersion: STRING,
        complete: BOOLEAN, scope: STRING, rowCount: BIGINT, path: STRING>>
"""
RECEIPT_FIELDS = ("id", "version", "capturedAt", "contractVersion", "complete", "scope", "rowCount", "path")
LEDGER = {
    "id": "id",
    "version": "version",
    "capturedAt": "captured_at",
    "contractVersion": "contract_version",
    "complete": "complete",
    "scope": "scope",
    "rowCount": "row_count",
    "path": "path",
}


def read_ledger(spark: SparkSession, paths: str | list[str], with_source: bool = False) -> DataFrame:
    """Receipts of any number of delivery indexes, one row each.

    An index that cannot be read, or lists nothing, keeps one row with NULL receipt fields so
    that an audit reports it.
    """
    text = spark.read.text(paths, wholetext=True)
    index = text.select(
        F.from_json("value", INDEX_SCHEMA).alias("i"),
        F.col("_metadata.file_path").alias("index_path"),
    )
    rows = index.select(
        F.col("i.dataset").alias("dataset"),
        F.col("i.apiVersion").alias("api_version"),
        "index_path",
        F.explode_outer("i.deliveries").alias("d"),
    )
    columns = [F.col(f"d.{field}").alias(column) for field, column in LEDGER.items()]
    extra = ["api_version", "index_path"] if with_source else []
    return rows.select("dataset", *columns, *extra)


def dataset_ledger(spark: SparkSession, path: str, dataset: str, api_version: str = API_VERSION) -> DataFrame:
    """Receipts of one dataset from its one index file; identity is checked first."""
    ledger = read_ledger(spark, path, with_source=True)
    named = ledger.select("index_path", "api_version", "dataset").distinct().take(2)
    reject = lambda ok, message: require(ok, message, DataRejected)
    reject(len(named) == 1, "A dataset has exactly one delivery index file")
    reject(
        named[0].api_version == api_version and named[0].dataset == dataset,
        "The delivery index has another format version or belongs to another dataset",
    )
    return ledger.drop("api_version", "index_path")
