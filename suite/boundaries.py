"""Queries for what stands at the edges of flows: readers, gates, publication, decisions, and views over views.

Each query derives its files from the given tables, writes them to the session's shared folder, and returns what the engine made of
them or decided on them. The same result in SQL stands beside it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from contractflow import AppendFlow, Column, Contract, Dataset, TableFlow, materialize, publish, sql_view
from contractflow.errors import DataRejected
from contractflow.functions import temporal
from contractflow.functions.rules import MANAGED, SNAPSHOT, VIEW, compile_rules
from contractflow.operators import quality
from contractflow.operators.ledger import Policy
from contractflow.operators.projection import TEMPORAL_FLAG, business_rules, invalid, preflight_parquet, project, required_rules
from contractflow.operators.verify import verify_snapshot
from contractflow.plans.graph import Input, View, ViewGraph
from contractflow.plans.publication import index_log
from contractflow.plans.snapshots import SnapshotFlow, from_published
from contractflow.plans.views import after_load
from contractflow.sources.datasets import result_store
from contractflow.sources.files import read_files, read_folder
from contractflow.sources.storage import CommitLog
from contractflow.sources.tables import checked_rows
from contractflow.streaming.feeds import from_landing

from . import inputs
from .flows import DATASET, NOW, _published_snapshots, scratch
from .inputs import table
from .oracle import SNAPSHOTS

QUERIES, SQL = {}, {}


def query(sql):
    def register(function):
        QUERIES[function.__name__], SQL[function.__name__] = function, sql
        return function

    return register


ORDERS = Contract("orders", (Column("o_orderkey", "BIGINT", required=True, key=True), Column("o_orderstatus", "STRING", target="status"), Column("o_orderdate", "DATE", target="day")))
_TEXTS = "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders"
_TYPED = "SELECT o_orderkey, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day FROM orders"


def order_texts(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


def decisions(spark, found) -> object:
    """(case, accepted, rows) of what was tried."""
    return spark.createDataFrame([(name, ok, int(n)) for name, ok, n in found], "case string, accepted boolean, rows bigint")


def accepted(action) -> bool:
    try:
        action()
    except DataRejected:
        return False
    return True


# --- readers ---------------------------------------------------------------------------------


@query("SELECT o_orderkey, status, day FROM (" + _TYPED + ") t")
def append_csv(spark, folder):
    root = scratch(spark)
    order_texts(spark, folder).write.option("header", True).csv(f"{root}/landing")
    flow = AppendFlow(ORDERS, f"{root}/landing", f"{root}/target", f"{root}/state", fmt="csv", reader={"header": True, "delimiter": ","})
    flow.run(spark)
    return Dataset(spark, flow.target).read().drop("_rescued_data")


@query("SELECT o_orderkey % 50 = 0 AS misfit, count(*) AS n, CAST(sum(CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END) AS BIGINT) AS total FROM orders GROUP BY 1")
def rescued_csv(spark, folder):
    root = scratch(spark)
    number = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("no "), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    table(spark, folder, "orders").select("o_orderkey", number.alias("o_custkey")).write.option("header", True).csv(f"{root}/landing")
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_custkey", "BIGINT")))
    rows = read_files(spark, f"{root}/landing", contract, "csv", {"header": True, "sep": ",", "enforceSchema": False})
    return rows.groupBy(F.col("_rescued_data").isNotNull().alias("misfit")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_custkey END AS o_custkey,
  CASE o_orderkey % 3 WHEN 1 THEN '{"o_custkey":"c' || o_custkey || '"}' WHEN 2 THEN '{"o_orderstatus":"' || o_orderstatus || '"}' END AS _rescued_data FROM orders""")  # fmt: skip
def rescued_parquet(spark, folder):
    """Files of three schemas in one folder: as declared, with another type, and with a column more."""
    root, orders = scratch(spark), table(spark, folder, "orders")
    other = F.concat(F.lit("c"), F.col("o_custkey")).alias("o_custkey")
    for part, columns in enumerate((["o_orderkey", "o_custkey"], ["o_orderkey", other], ["o_orderkey", "o_custkey", "o_orderstatus"])):
        orders.where(F.col("o_orderkey") % 3 == part).select(*columns).write.mode("append").parquet(f"{root}/landing")
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_custkey", "BIGINT")))
    return read_files(spark, f"{root}/landing", contract, "parquet")


@query(_TEXTS)
def json_documents(spark, folder):
    """Files that each hold one printed array of records over many lines."""
    root = scratch(spark)
    records = order_texts(spark, folder).withColumn("part", F.col("o_orderkey") % 16)
    documents = records.groupBy("part").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_orderdate")).alias("r"))
    documents.select("part", F.to_json("r", {"pretty": "true"}).alias("value")).write.partitionBy("part").text(f"{root}/landing")
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_orderstatus", "STRING"), Column("o_orderdate", "STRING")))
    return read_files(spark, f"{root}/landing/*", contract, "json", {"multiLine": True}).where("_rescued_data IS NULL").drop("_rescued_data")


@query(_TYPED)
def folder_formats(spark, folder):
    """A quarter of the orders in each of four formats."""
    root, out = scratch(spark), None
    for part, fmt in enumerate(("csv", "json", "xml", "parquet")):
        rows = order_texts(spark, folder).where(F.col("o_orderkey") % 4 == part)
        rows = rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date")) if fmt == "parquet" else rows
        rows.write.format(fmt).options(**{"csv": {"header": True}, "xml": {"rowTag": "row"}}.get(fmt, {})).save(f"{root}/{fmt}")
        read = read_folder(spark, f"{root}/{fmt}", ORDERS, fmt, row_tag="row")
        out = read if out is None else out.unionByName(read)
    return out


@query("SELECT o_orderkey, o_orderdate AS cursor FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def query_cursor(spark, folder):
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_orderdate", "TIMESTAMP", target="cursor")))
    return checked_rows(table(spark, folder, "orders"), contract, "o_orderdate", inputs.HIGH_WATER_MARK)


@query(f"WITH {SNAPSHOTS} SELECT * FROM v3")
def published_input(spark, folder):
    """The current rows of a flow over snapshots that another flow published."""
    root = scratch(spark)
    upstream = _published_snapshots(spark, folder, root)
    flow = from_published(inputs.customer_contract(), upstream.contract, DATASET, upstream.index, upstream.source_root, target=f"{root}/consumer")
    flow.catch_up(spark, NOW)
    return Dataset(spark, flow.target).read()


@query("SELECT o_orderkey, status, day FROM (" + _TYPED + ") t")
def landed_input(spark, folder):
    root = scratch(spark)
    order_texts(spark, folder).write.json(f"{root}/landing")
    flow = from_landing(ORDERS, ORDERS, source=f"{root}/landing", target=f"{root}/target", checkpoint=f"{root}/state")
    flow.run(spark)
    return Dataset(spark, flow.target).read().drop("_rescued_data")


@query(f"WITH {SNAPSHOTS} SELECT 1 AS version, count(*) AS n, CAST(sum(c_nationkey) AS BIGINT) AS total FROM v1 UNION ALL SELECT 2, count(*), CAST(sum(c_nationkey) AS BIGINT) FROM v2")
def pinned_read(spark, folder):
    """The first version of a table stays readable after the second."""
    flow = TableFlow(f"{scratch(spark)}/target", inputs.customer_contract(), None)
    target = Dataset(spark, flow.target)
    for _, rows in inputs.customer_snapshots(spark, folder)[:2]:
        TableFlow(flow.target, flow.contract, lambda session, mark, rows=rows: rows).run(spark)
    out = None
    for number in (1, 2):
        rows, version = target.read_pinned(number=number)
        counted = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("c_nationkey").alias("total")).select(F.lit(version).alias("version"), "n", "total")
        out = counted if out is None else out.unionByName(counted)
    return out


@query("""WITH r AS (SELECT conv_id, turn, role, text, lag(role) OVER w AS r0, lag(text) OVER w AS t0, lag(turn) OVER w AS n0 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, sum(CASE WHEN n0 IS NULL OR role IS DISTINCT FROM r0 OR text IS DISTINCT FROM t0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM r),
v AS (SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text, min(turn) AS start_at FROM s GROUP BY conv_id, run)
SELECT conv_id, turn, role AS "role", text, start_at AS "__START_AT", lead(start_at) OVER (PARTITION BY conv_id ORDER BY start_at) AS "__END_AT" FROM v""")  # fmt: skip
def flow_reserved_names(spark, folder):
    """Histories with a column ``role``, one that folders of earlier engines were named by."""
    contract = Contract("conversations", (Column("conv_id", "BIGINT", required=True, key=True), Column("turn", "BIGINT"), Column("role", "STRING"), Column("text", "STRING")))
    rows = table(spark, folder, "conversations")
    seen = {"rows": rows.where("turn < 2")}
    flow = TableFlow(f"{scratch(spark)}/target", contract, lambda session, mark: seen["rows"], "SCD_TYPE_2", cursor="turn", buckets=8)
    flow.run(spark)
    seen["rows"] = rows
    flow.run(spark)
    return Dataset(spark, flow.target).read("history")


# --- gates -----------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderkey % 40 = 0 AS refused FROM orders")
def year_guard(spark, folder):
    late = F.expr("CASE WHEN o_orderkey % 40 = 0 THEN o_orderdate + INTERVAL '9000' YEAR ELSE o_orderdate END")
    rows = table(spark, folder, "orders").select("o_orderkey", late.alias("o_orderdate"))
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_orderdate", "TIMESTAMP")))
    return project(rows, contract, "parquet", on_invalid="report").select("o_orderkey", F.col(TEMPORAL_FLAG).alias("refused"))


@query("SELECT * FROM (VALUES ('as declared', true), ('zoned', false), ('date', false), ('mixed files', false)) t(\"case\", accepted), (SELECT count(*) AS rows FROM orders)")
def parquet_preflight(spark, folder):
    root = scratch(spark)
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    contract = Contract("orders", (Column("o_orderkey", "BIGINT"), Column("o_orderdate", "TIMESTAMP")))
    zoned = rows.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    written = {"as declared": [rows], "zoned": [zoned], "date": [rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))], "mixed files": [rows.where("o_orderkey % 2 = 0"), zoned.where("o_orderkey % 2 = 1")]}
    found = []
    for case, frames in written.items():
        for frame in frames:
            frame.write.mode("append").parquet(f"{root}/{case.split()[0]}")
        path = f"{root}/{case.split()[0]}"
        found.append((case, accepted(lambda path=path: preflight_parquet(spark, path, contract)), sum(f.count() for f in frames)))
    return decisions(spark, found)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 8 >= 6")
def guarded_dates(spark, folder):
    """Typed values of a projection that would fail the query on the first text that is not exact."""
    exact = inputs.texts(spark, folder).where("o_orderkey % 8 >= 6")
    return exact.select("o_orderkey", temporal.parse_or_fail(F.col("day"), "DATE").alias("day"))


@query("SELECT 'snapshot' AS \"case\", false AS accepted, count(*) AS rows FROM orders WHERE o_orderkey % 97 = 0 UNION ALL SELECT 'repaired', true, count(*) FROM orders")
def temporal_gate(spark, folder):
    """A snapshot with one kind of bad date is refused as a whole; repaired, it is applied as a whole."""
    root, found = scratch(spark), []
    contract = Contract(ORDERS.table, ORDERS.columns, "1.0.0")
    for version, (case, bad) in enumerate((("snapshot", F.col("o_orderkey") % 97 == 0), ("repaired", F.lit(False))), 1):
        rows = order_texts(spark, folder).withColumn("o_orderdate", F.when(bad, "1999-02-29").otherwise(F.col("o_orderdate")))
        path = f"{root}/landing/run_{version}"
        rows.write.json(path)
        receipt = {"id": f"d{version}", "version": 1, "capturedAt": "2024-05-01T00:00:00Z", "contractVersion": "1.0.0", "complete": True, "scope": "full-table", "rowCount": rows.count(), "path": path}
        publish(spark, f"{root}/landing/_{version}", receipt, DATASET, f"{root}/landing", verify=lambda: None, initialise=True, now=NOW)
        flow = SnapshotFlow(DATASET, contract, f"{root}/landing", f"{root}/landing/_{version}", f"{root}/target{version}", fmt="json")
        ok = accepted(lambda flow=flow: flow.catch_up(spark, NOW))
        found.append((case, ok, Dataset(spark, flow.target).read().count() if ok else rows.where(bad).count()))
    return decisions(spark, found)


_FAULTY = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice FROM orders"


@query(f"SELECT o_orderkey FROM ({_FAULTY}) t WHERE o_orderkey IS NULL OR NOT coalesce(o_orderstatus <> 'F', false) OR NOT coalesce(o_totalprice > 1000, false)")
def invalid_rows(spark, folder):
    contract = inputs.order_contract()
    rules = {**required_rules(contract, contract.keys), **business_rules({"open": "o_orderstatus <> 'F'", "large": "o_totalprice > 1000"})}
    return inputs.quality_orders(spark, folder).where(invalid(rules)).select("o_orderkey")


# --- rules -----------------------------------------------------------------------------------


def _present(column, **more):
    return (column, {"id": f"{column}-present", "metric": "nullValues", "mustBe": 0, **more})


@query("""SELECT id, outcome, value, passed, enforcement FROM (
  SELECT 'o_orderstatus-present' AS id, 'fail' AS outcome, CAST(count(*) FILTER (o_orderkey % 7 = 0) AS VARCHAR) AS value, count(*) FILTER (o_orderkey % 7 = 0) = 0 AS passed FROM orders
  UNION ALL SELECT 'o_custkey-present', 'warn', '0', true UNION ALL SELECT 'rows', 'warn', CAST(count(*) AS VARCHAR), true FROM orders) r,
  (VALUES ('before-load'), ('after-load')) b(enforcement)""")  # fmt: skip
def rule_results(spark, folder):
    """Results are stored at both boundaries, also those of data that a required rule refuses."""
    store = f"{scratch(spark)}/results"
    contract = inputs.order_contract(_present("o_orderstatus", severity="error"), _present("o_custkey"), table_rules=({"id": "rows", "metric": "rowCount", "mustBeGreaterThan": 0},))
    results = quality.evaluate(inputs.quality_orders(spark, folder), compile_rules(contract, SNAPSHOT))
    for boundary in (quality.BEFORE_LOAD, quality.AFTER_LOAD):
        accepted(lambda boundary=boundary: quality.enforce(results, boundary, result_store(spark, store), {"table": "orders"}))
    return Dataset(spark, store).read().drop("context")


@query("SELECT 'exact' AS id, CAST(sum(CAST(o_orderkey AS DECIMAL(20,0)) * 1000000000000) + 1 AS VARCHAR) AS value, true AS passed FROM orders")
def exact_metrics(spark, folder):
    """A number far beyond a double's digits is compared and kept exactly."""
    whole = table(spark, folder, "orders").agg(F.sum("o_orderkey").alias("n")).first().n * 10**12 + 1
    exact = {"id": "exact", "type": "sql", "query": "SELECT sum(CAST(o_orderkey AS DECIMAL(20,0)) * 1000000000000) + 1 FROM ${table}", "mustBe": whole}
    checks = compile_rules(inputs.order_contract(table_rules=(exact,)), SNAPSHOT)
    return quality.evaluate(table(spark, folder, "orders"), checks).select("id", "value", "passed")


@query("SELECT 'status-present' AS rule, count(*) AS n FROM orders WHERE o_orderkey % 7 = 0")
def stream_warnings(spark, folder):
    """Rows that break a rule with a warning stay, and their number is kept with the batch."""
    root = scratch(spark)
    texts = order_texts(spark, folder).withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END"))
    texts.coalesce(1).write.json(f"{root}/landing")
    columns = [Column(c.name, c.type, c.target, c.required, c.key, ({"id": "status-present", "metric": "nullValues", "mustBe": 0},) if c.output == "status" else ()) for c in ORDERS.columns]
    flow = AppendFlow(Contract("orders", tuple(columns)), f"{root}/landing", f"{root}/target", f"{root}/state")
    flow.run(spark)
    return spark.createDataFrame(list(Dataset(spark, flow.target).version().info["warnings"].items()), "rule string, n bigint")


# --- publication -----------------------------------------------------------------------------


@query("""SELECT "case", accepted, n AS rows FROM (VALUES ('as declared', true), ('other order', false), ('other type', false), ('one row less', false), ('a null key', false), ('a repeated key', false)) t("case", accepted),
  (SELECT count(*) AS n FROM customer)""")  # fmt: skip
def snapshot_verification(spark, folder):
    contract, rows = inputs.customer_contract(), table(spark, folder, "customer")
    n, key = rows.count(), F.col("c_custkey")
    least = rows.agg(F.min("c_custkey")).first()[0]
    cases = {
        "as declared": rows, "other order": rows.select(*reversed(rows.columns)), "other type": rows.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")),
        "one row less": rows.where(key != least), "a null key": rows.withColumn("c_custkey", F.when(key != least, key)),
        "a repeated key": rows.withColumn("c_custkey", F.when(key == least, key + 1).otherwise(key)),
    }
    return decisions(spark, [(case, accepted(lambda frame=frame: verify_snapshot(frame, contract, n)), n) for case, frame in cases.items()])


class Losing(CommitLog):
    """A log in which another publisher wins the first race."""

    def append(self, number: int, body: bytes) -> None:
        if not hasattr(self, "lost"):
            self.lost = True
            super().append(number, body)
        super().append(number, body)


@query("""SELECT step, status, n AS rows FROM (VALUES ('first', 'published'), ('again', 'already-published'), ('other metadata', 'refused'), ('gap', 'refused'), ('lost race', 'already-published'), ('empty', 'refused')) t(step, status),
  (SELECT count(*) AS n FROM customer WHERE c_custkey % 10 <> 9)""")  # fmt: skip
def publication_steps(spark, folder):
    root, contract = scratch(spark), inputs.customer_contract()
    rows = inputs.customer_snapshots(spark, folder)[0][1]
    n, found = rows.count(), []
    for run in ("run_1", "run_2"):
        rows.write.parquet(f"{root}/{run}")
    first = {"id": "a", "version": 1, "capturedAt": "2024-05-01T00:00:00Z", "contractVersion": contract.version, "complete": True, "scope": "full-table", "rowCount": n, "path": f"{root}/run_1"}
    second = {**first, "id": "b", "version": 2, "path": f"{root}/run_2"}
    log = index_log(spark, f"{root}/_index")
    losing = Losing(log.storage, log.folder, log.prefix)
    for step, receipt, kept in (("first", first, log), ("again", first, log), ("other metadata", {**first, "rowCount": n + 1}, log), ("gap", {**second, "version": 3}, log), ("lost race", second, losing), ("empty", {**second, "id": "c", "version": 3, "rowCount": 0}, log)):
        try:
            status = publish(spark, f"{root}/_index", receipt, DATASET, root, contract, Policy(), initialise=step == "first", now=NOW, log=kept)["status"]
        except DataRejected:
            status = "refused"
        found.append((step, status, n))
    return spark.createDataFrame(found, "step string, status string, rows bigint")


# --- views -----------------------------------------------------------------------------------

PER_STATUS = Contract("report", (Column("status", "STRING", key=True), Column("orders", "BIGINT"), Column("total", "DECIMAL(38,2)")))


@query("SELECT 'report.status.key-not-null' AS id, '0' AS value, true AS passed UNION ALL SELECT 'report.key-unique', CAST(count(*) - count(DISTINCT o_orderstatus) AS VARCHAR), count(*) = count(DISTINCT o_orderstatus) FROM orders")
def view_rules(spark, folder):
    """Rules that a view's key implies, judged on the committed view: it repeats its keys."""
    contract, target = Contract("report", (Column("status", "STRING", key=True),)), f"{scratch(spark)}/report"
    made = sql_view(spark, "SELECT o_orderstatus FROM orders", {"orders": table(spark, folder, "orders")}, contract)
    accepted(lambda: materialize(spark, made, target, contract))
    checks = [c for c in compile_rules(contract, VIEW)]
    judged = quality.check_table(Dataset(spark, target).read(), contract, checks)
    assert not accepted(lambda: after_load(Dataset(spark, target), contract, checks))
    return judged.select("id", "value", "passed")


@query("""WITH a AS (SELECT o_orderstatus AS status, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(38,2)) AS total FROM orders GROUP BY 1)
SELECT status, orders, CAST(total AS DECIMAL(38,2)) AS total, step, refreshed FROM a, (VALUES (1, 'per_status,best'), (2, ''), (3, 'per_status,best')) s(step, refreshed)
WHERE total = (SELECT max(total) FROM a)""")  # fmt: skip
def view_over_view(spark, folder):
    """A view over a view over a dataset: built in order, left alone where nothing moved, and built again after a new version."""
    root, out = scratch(spark), None
    orders = table(spark, folder, "orders")
    Dataset(spark, f"{root}/orders").replace_table(orders)
    amounts = "SELECT o_orderstatus, count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(38,2)) FROM orders GROUP BY o_orderstatus"
    best = View("best", "SELECT * FROM per_status WHERE total = (SELECT max(total) FROM per_status)", PER_STATUS, f"{root}/best", views=("per_status",))
    graph = ViewGraph((best, View("per_status", amounts, PER_STATUS, f"{root}/per_status", {"orders": Input(f"{root}/orders")})))
    for step in (1, 2, 3):
        if step == 3:
            Dataset(spark, f"{root}/orders").replace_table(orders.repartition(3))
        built = ",".join(graph.refresh(spark))
        rows = Dataset(spark, f"{root}/best").read().select("*", F.lit(step).alias("step"), F.lit(built).alias("refreshed"))
        out = rows if out is None else out.unionByName(rows)
    return out
