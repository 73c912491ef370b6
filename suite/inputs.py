"""Inputs of the suite's queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.contract import Column, Contract

HIGH_WATER_MARK = "1998-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customer_snapshots(spark: SparkSession, folder: str) -> list[tuple[int, DataFrame]]:
    """Three complete deliveries with inserts, updates, deletes and reappearing keys."""
    rows = table(spark, folder, "customer")
    second = rows.where("c_custkey % 7 <> 3").withColumn(
        "c_acctbal", F.expr("CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END")
    )
    third = rows.withColumn(
        "c_mktsegment", F.expr("CASE WHEN c_custkey % 11 = 0 THEN 'CHURN' ELSE c_mktsegment END")
    )
    return [(1, rows.where("c_custkey % 10 <> 9")), (2, second), (3, third)]


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Full-row events per user: signup inserts, error deletes, anything else updates."""
    operation = F.expr("CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END")
    return table(spark, folder, "events").select(
        "user_id", "event_id", "ts", operation.alias("op"), "event_type", "value"
    )


def cursor_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a cursor that some rows lack."""
    cursor = F.expr("CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END")
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", cursor.alias("cursor"))


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    """A ledger with one dataset per order and one delivery per line, many of them faulty."""
    case = lambda text: F.expr(text)
    return table(spark, folder, "lineitem").select(
        case("concat('retail.sales.o', l_orderkey)").alias("dataset"),
        case(
            "CASE WHEN l_partkey % 71 = 0 THEN '' WHEN l_partkey % 50 = 0 THEN 'd_fixed' "
            "ELSE concat('d', l_partkey, '_', l_suppkey) END"
        ).alias("id"),
        case("CAST(l_linenumber AS BIGINT)").alias("version"),
        case(
            "concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T00:00:00', "
            "CASE WHEN l_suppkey % 29 = 0 THEN '' ELSE 'Z' END)"
        ).alias("captured_at"),
        case("CASE WHEN l_suppkey % 31 = 0 THEN '' ELSE '1.0.0' END").alias("contract_version"),
        case("l_partkey % 37 <> 0").alias("complete"),
        case("CASE WHEN l_partkey % 43 = 0 THEN 'partial' ELSE 'full-table' END").alias("scope"),
        case(
            "CASE WHEN l_partkey % 61 = 0 THEN 0 WHEN l_partkey % 67 = 0 THEN -1 "
            "ELSE CAST(l_quantity AS BIGINT) * 10 END"
        ).alias("row_count"),
        case(
            "CASE WHEN l_suppkey % 17 = 0 THEN '/landing/a/../run' WHEN l_suppkey % 19 = 0 THEN '/other/run' "
            "ELSE concat('/landing/run_', l_partkey, '_', l_suppkey) END"
        ).alias("path"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with date and timestamp texts, most of which are not exact."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr(
            "CASE o_orderkey % 8 WHEN 0 THEN date_format(o_orderdate, 'yyyy-M-d') WHEN 1 THEN '2023-02-29' "
            "WHEN 2 THEN '0000-01-01' WHEN 3 THEN NULL "
            "WHEN 4 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), chr(10)) "
            "WHEN 5 THEN concat(' ', date_format(o_orderdate, 'yyyy-MM-dd')) "
            "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
        ).alias("day"),
        F.expr(
            "concat(date_format(o_orderdate, 'yyyy-MM-dd'), CASE o_orderkey % 8 WHEN 0 THEN 'T01:02:03.1234567' "
            "WHEN 1 THEN 'T01:02:03+13:00' WHEN 2 THEN 'T01:02:03Z' WHEN 3 THEN 'T25:02:03' "
            "WHEN 4 THEN 'T01:02:03.123456' WHEN 5 THEN ' 01:02:03' WHEN 6 THEN '' ELSE 'T01:02:03.5' END)"
        ).alias("event"),
    )


def order_contract(*rules, table_rules=(), keys=("o_orderkey",)) -> Contract:
    """Contract of the orders input; ``rules`` are (column, rule) pairs."""
    types = {
        "o_orderkey": "BIGINT",
        "o_custkey": "BIGINT",
        "o_orderstatus": "STRING",
        "o_totalprice": "DOUBLE",
        "o_orderdate": "TIMESTAMP",
        "o_orderpriority": "STRING",
        "o_day": "DATE",
    }
    columns = [
        Column(c, t, required=c in keys, key=c in keys, quality=tuple(r for name, r in rules if name == c))
        for c, t in types.items()
    ]
    return Contract("orders", tuple(columns), "1.0.0", tuple(table_rules))


def quality_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with missing values and a DATE column."""
    return table(spark, folder, "orders").withColumns(
        {
            "o_orderstatus": F.expr("CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END"),
            "o_orderpriority": F.expr("CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END"),
            "o_day": F.expr("CAST(o_orderdate AS DATE)"),
        }
    )


def customer_contract() -> Contract:
    return Contract(
        "customer",
        (
            Column("c_custkey", "BIGINT", required=True, key=True),
            Column("c_name", "STRING"),
            Column("c_nationkey", "INT"),
            Column("c_acctbal", "DOUBLE"),
            Column("c_mktsegment", "STRING"),
        ),
        "1.0.0",
    )


def feed_contract(*rules) -> Contract:
    types = {"user_id": "BIGINT", "event_id": "BIGINT", "op": "STRING", "event_type": "STRING", "value": "DOUBLE"}
    columns = [
        Column(c, t, required=c in ("user_id", "value"), key=c == "user_id", quality=tuple(r for n, r in rules if n == c))
        for c, t in types.items()
    ]
    return Contract("feed", tuple(columns), "1.0.0")
