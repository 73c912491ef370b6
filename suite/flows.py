"""Whole flows over the given tables: deliveries are written to the session's shared folder, applied,
and the committed result is read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from contractflow import AppendFlow, ChangeFlow, Column, Contract, Dataset, SnapshotFlow, TableFlow, materialize, publish, sql_view
from contractflow.session import shared_folder

from . import inputs
from .inputs import table
from .views import VIEWS

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
DATASET = "retail.erp.customer"
FLOWS = {}


def flow(function):
    FLOWS[function.__name__] = function
    return function


def scratch(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _published_snapshots(spark, folder, root) -> SnapshotFlow:
    """Land and publish three snapshots; the flow that consumes them."""
    contract, landing = inputs.customer_contract(), f"{root}/landing"
    for version, rows in inputs.customer_snapshots(spark, folder):
        path = f"{landing}/run_{version}"
        rows.write.parquet(path)
        receipt = {
            "id": f"delivery_{version}",
            "version": version,
            "capturedAt": f"2024-05-{version:02d}T00:00:00Z",
            "contractVersion": contract.version,
            "complete": True,
            "scope": "full-table",
            "rowCount": spark.read.parquet(path).count(),
            "path": path,
        }
        publish(spark, f"{landing}/_index", receipt, DATASET, landing, contract, initialise=version == 1, now=NOW)
    return SnapshotFlow(DATASET, contract, landing, f"{landing}/_index", f"{root}/target")


@flow
def flow_snapshots(spark, folder):
    root = scratch(spark)
    applied = _published_snapshots(spark, folder, root)
    applied.catch_up(spark, NOW)
    return Dataset(spark, applied.target).read("history")


@flow
def flow_rebuild(spark, folder):
    root = scratch(spark)
    return _published_snapshots(spark, folder, root).rebuild(spark, f"{root}/rebuilt", 2).read("history")


@flow
def flow_change_feed(spark, folder):
    """Every third event arrives late, in a second batch."""
    root = scratch(spark)
    feed = inputs.change_feed(spark, folder).drop("ts")
    applied = ChangeFlow(
        inputs.feed_contract(),
        f"{root}/landing/*",
        f"{root}/target",
        f"{root}/state",
        fmt="parquet",
        sequence="event_id",
        operation_column="op",
        tracked=["event_type"],
        buckets=8,
    )
    for name, part in {"first": "event_id % 3 <> 0", "late": "event_id % 3 = 0"}.items():
        feed.where(part).select(*inputs.feed_contract().names).write.parquet(f"{root}/landing/{name}")
        applied.run(spark)
    return Dataset(spark, applied.target).read("history")


@flow
def flow_append(spark, folder):
    root = scratch(spark)
    contract = Contract(
        "orders",
        (
            Column("o_orderkey", "BIGINT", required=True),
            Column("o_orderstatus", "STRING", target="status"),
            Column("o_orderdate", "TIMESTAMP"),
        ),
    )
    applied = AppendFlow(contract, f"{root}/landing/*", f"{root}/target", f"{root}/state")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    for name, part in {"first": "o_orderkey % 2 = 0", "second": "o_orderkey % 2 = 1"}.items():
        orders.where(part).write.json(f"{root}/landing/{name}")
        applied.run(spark)
    return Dataset(spark, applied.target).read().drop("_rescued_data")


def _cursor_flow(spark, folder, mode) -> Dataset:
    """Two runs over the events, the first of which sees only the older half."""
    contract = Contract(
        "events",
        (
            Column("user_id", "BIGINT", required=True, key=True),
            Column("ts", "TIMESTAMP"),
            Column("event_type", "STRING"),
            Column("value", "DOUBLE"),
        ),
    )
    events = table(spark, folder, "events").select(*contract.names)
    seen = {"rows": events.where("ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'")}
    applied = TableFlow(f"{scratch(spark)}/target", contract, lambda session, mark: seen["rows"], mode, cursor="ts")
    if mode == "SCD_TYPE_1":
        # A first extract with one row per key, as a source table has.
        latest = seen["rows"].groupBy("user_id").agg(F.max(F.struct("ts", "event_type", "value")).alias("r"))
        seen["rows"] = latest.select("user_id", "r.*")
    applied.run(spark)
    seen["rows"] = events
    applied.run(spark)
    return Dataset(spark, applied.target)


@flow
def flow_table_scd1(spark, folder):
    return _cursor_flow(spark, folder, "SCD_TYPE_1").read()


@flow
def flow_table_scd2(spark, folder):
    return _cursor_flow(spark, folder, "SCD_TYPE_2").read("history")


@flow
def flow_view(spark, folder):
    sources, columns, text = VIEWS["mv_aggregate"]
    contract = Contract("report", tuple(Column(c, t) for c, t in columns.items()))
    target = f"{scratch(spark)}/report"
    result = sql_view(spark, text, {s: table(spark, folder, s) for s in sources}, contract)
    materialize(spark, result, target, contract)
    return Dataset(spark, target).read()
