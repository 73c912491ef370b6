"""One query per operator of the engine, over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractflow.contract import END_AT, START_AT, Column, Contract
from contractflow.functions.rules import EVENTS, MANAGED, SNAPSHOT, compile_rules, expectations
from contractflow.operators import history, ledger, quality
from contractflow.operators.projection import TEMPORAL_FLAG, business_columns, count_failures, current_rows, project, row_violations
from contractflow.operators.verify import duplicate_keys
from contractflow.plans.tables import advance_by_cursor
from contractflow.plans.views import python_view, sql_view
from contractflow.sources.files import rescue_json
from contractflow.sources.tables import read_extract

from . import inputs
from .inputs import table
from .views import VIEWS

QUERIES = {}
CUSTOMER = ["c_custkey"]


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- history ---------------------------------------------------------------------------------


@query
def scd2_snapshots(spark, folder):
    return history.scd2_from_snapshot_series(inputs.customer_snapshots(spark, folder), CUSTOMER)


@query
def scd2_snapshots_tracked(spark, folder):
    return history.scd2_from_snapshot_series(inputs.customer_snapshots(spark, folder), CUSTOMER, ["c_mktsegment"])


@query
def scd2_snapshots_stepwise(spark, folder):
    built = closed = None
    for version, rows in inputs.customer_snapshots(spark, folder):
        changed = history.advance_snapshot(built and current_rows(built), rows, CUSTOMER, version)
        ended = changed.where(F.col(END_AT).isNotNull())
        closed = ended if closed is None else closed.unionByName(ended)
        built = changed
    return current_rows(built).unionByName(closed)


@query
def current_from_history(spark, folder):
    rows = current_rows(scd2_snapshots(spark, folder))
    return business_columns(rows, inputs.customer_contract())


@query
def snapshot_diff(spark, folder):
    (_, first), (_, second), _ = inputs.customer_snapshots(spark, folder)
    return history.snapshot_diff(first, second, CUSTOMER)


def _events(spark, folder) -> DataFrame:
    return inputs.change_feed(spark, folder).drop("ts")


@query
def scd2_events(spark, folder):
    return history.scd2_from_events(_events(spark, folder), ["user_id"], "event_id", operation="op")


@query
def scd2_events_tracked(spark, folder):
    return history.scd2_from_events(
        _events(spark, folder), ["user_id"], "event_id", operation="op", tracked=["event_type"]
    )


@query
def scd2_composite_key(spark, folder):
    feed = table(spark, folder, "events").select(
        "user_id", "event_type", "event_id", F.expr("CASE WHEN event_id % 11 = 0 THEN 'D' ELSE 'U' END").alias("op"), "value"
    )
    return history.scd2_from_events(feed, ["user_id", "event_type"], "event_id", operation="op")


@query
def scd2_struct_sequence(spark, folder):
    feed = inputs.change_feed(spark, folder)
    rows = history.scd2_from_events(feed, ["user_id"], ["ts", "event_id"], operation="op")
    return rows.select(
        "user_id",
        "event_type",
        "value",
        F.col(START_AT)["ts"].alias("start_ts"),
        F.col(START_AT)["event_id"].alias("start_id"),
        F.col(END_AT)["ts"].alias("end_ts"),
        F.col(END_AT)["event_id"].alias("end_id"),
    )


@query
def sequence_conflicts(spark, folder):
    return history.sequence_conflicts(table(spark, folder, "lineitem"), ["l_orderkey"], "l_linenumber")


@query
def scd1_upsert(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "ts", "event_type", "value", "event_id")
    stored = history.latest_rows(rows.where("event_id % 2 = 0"), ["user_id"], "ts")
    updates = rows.where("event_id % 2 = 1")
    return history.scd1_merge(stored, updates, ["user_id"], "ts", deleted="event_type = 'error'")


@query
def scd2_cursor(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "ts", "event_type", "value")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    first = advance_by_cursor(None, rows.where(F.col("ts") < middle), ["user_id"], "ts")
    second = advance_by_cursor(current_rows(first), rows.where(F.col("ts") >= middle), ["user_id"], "ts")
    return first.where(F.col(END_AT).isNotNull()).unionByName(second)


@query
def full_refresh_scd2(spark, folder):
    first, _, last = (rows for _, rows in inputs.customer_snapshots(spark, folder))
    return history.scd2_from_snapshots(history.apply_snapshot(None, first, CUSTOMER, 1), last, CUSTOMER, 2)


@query
def history_reconcile(spark, folder):
    return history.reconcile(scd2_snapshots(spark, folder), scd2_snapshots_tracked(spark, folder))


@query
def cursor_increment(spark, folder):
    mark = F.lit(inputs.HIGH_WATER_MARK).cast("timestamp_ntz")
    return history.after_cursor(inputs.cursor_orders(spark, folder), "cursor", mark)


@query
def append_only_increment(spark, folder):
    mark = F.lit(inputs.HIGH_WATER_MARK).cast("timestamp_ntz")
    rows = inputs.cursor_orders(spark, folder)
    return history.append_only(rows.where(F.col("cursor") <= mark), history.after_cursor(rows, "cursor", mark))


@query
def cursor_hwm(spark, folder):
    return history.high_water_mark(cursor_increment(spark, folder), "cursor")


# --- projection and row rules ----------------------------------------------------------------


@query
def include_columns(spark, folder):
    contract = Contract("part", (Column("p_partkey", "BIGINT"), Column("p_brand", "STRING"), Column("p_size", "INT")))
    return read_extract(table(spark, folder, "part"), contract)


@query
def column_mapping_swap(spark, folder):
    contract = Contract(
        "events",
        (
            Column("event_id", "BIGINT"),
            Column("event_type", "STRING", target="props"),
            Column("props", "STRING", target="event_type"),
        ),
    )
    return project(table(spark, folder, "events"), contract)


@query
def strict_date_parse(spark, folder):
    contract = Contract("texts", (Column("o_orderkey", "BIGINT"), Column("day", "DATE")))
    flagged = project(inputs.texts(spark, folder), contract, "json", on_invalid="report")
    return flagged.withColumnRenamed(TEMPORAL_FLAG, "_temporal_invalid")


@query
def strict_ts_parse(spark, folder):
    contract = Contract("texts", (Column("o_orderkey", "BIGINT"), Column("event", "TIMESTAMP")))
    flagged = project(inputs.texts(spark, folder), contract, "json", on_invalid="report")
    return flagged.withColumnRenamed(TEMPORAL_FLAG, "_temporal_invalid")


@query
def required_violations(spark, folder):
    feed = _events(spark, folder).withColumns(
        {
            "value": F.expr("CASE WHEN event_id % 5 <> 0 THEN value END"),
            "op": F.expr("CASE WHEN event_id % 101 = 0 THEN 'X' ELSE op END"),
        }
    )
    return row_violations(feed, inputs.feed_contract(), sequence=["event_id"], operation="op")


@query
def business_expectation(spark, folder):
    return row_violations(
        inputs.quality_orders(spark, folder),
        inputs.order_contract(),
        expectations={"positive": "o_totalprice > 1000", "known": "o_orderstatus IN ('O', 'F')"},
    )


@query
def rescued_json(spark, folder):
    contract = Contract("props", (Column("k", "BIGINT"),))
    text = table(spark, folder, "events").select(
        "event_id",
        F.expr(
            "CASE WHEN event_id % 13 = 0 THEN '{\"k\": \"x\"}' WHEN event_id % 17 = 0 THEN '{\"k\": 1, \"z\": 2}' "
            "WHEN event_id % 19 = 0 THEN '{\"k\": ' ELSE props END"
        ).alias("value"),
    )
    return rescue_json(text, contract)


# --- ledger ----------------------------------------------------------------------------------


def _rules(found: DataFrame, *rules: str) -> DataFrame:
    return found.where(F.col("rule").isin(*rules)).select("dataset", "version", "rule")


AUDITED_AT = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)


@query
def ledger_pending(spark, folder):
    latest = table(spark, folder, "orders").where("o_orderkey % 3 <> 0").select(
        F.expr("concat('retail.sales.o', o_orderkey)").alias("dataset"), F.expr("o_orderkey % 5").alias("latest")
    )
    return ledger.pending(inputs.receipts(spark, folder), latest).select("dataset", "version", "id")


@query
def ledger_bad_receipts(spark, folder):
    found = ledger.receipt_violations(inputs.receipts(spark, folder), "/landing", publication=True)
    return _rules(found, "id", "row_count", "captured_at", "contract_version", "complete")


@query
def ledger_duplicates(spark, folder):
    found = ledger.duplicate_violations(inputs.receipts(spark, folder))
    return found.select("dataset", "version", "rule", F.col("detail").cast("bigint").alias("copies"))


@query
def ledger_paths(spark, folder):
    return _rules(ledger.receipt_violations(inputs.receipts(spark, folder), "/landing", publication=True), "path")


@query
def ledger_gaps(spark, folder):
    return _rules(ledger.order_violations(inputs.receipts(spark, folder)), "gap")


@query
def ledger_time_order(spark, folder):
    return _rules(ledger.order_violations(inputs.receipts(spark, folder)), "time_order")


@query
def ledger_drop_percent(spark, folder):
    found = ledger.order_violations(inputs.receipts(spark, folder), maximum_drop_percent=60)
    return _rules(found, "drop_percent")


@query
def ledger_row_policy(spark, folder):
    found = ledger.policy_violations(inputs.receipts(spark, folder), ledger.Policy(minimum_rows=50))
    return _rules(found, "minimum_rows", "empty")


@query
def ledger_stale(spark, folder):
    policy = ledger.Policy(maximum_age_hours=17520)
    return _rules(ledger.stale_violations(inputs.receipts(spark, folder), policy, AUDITED_AT), "stale", "future")


@query
def ledger_audit(spark, folder):
    """Violations per rule of a whole audit."""
    policy = ledger.Policy(minimum_rows=50, maximum_drop_percent=60, maximum_age_hours=17520)
    found = ledger.audit(inputs.receipts(spark, folder), policy, "/landing", publication=True, now=AUDITED_AT)
    return found.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))


@query
def ledger_contract_mismatch(spark, folder):
    waiting = ledger.pending(inputs.receipts(spark, folder))
    return ledger.contract_violations(waiting, "1.0.0").select("dataset", "version", "rule")


@query
def key_uniqueness(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- quality ---------------------------------------------------------------------------------


def _results(results: DataFrame) -> DataFrame:
    return results.select("id", "outcome", F.col("value").cast("double").alias("value"), "passed")


def _orders(spark, folder, *rules, table_rules=(), standard=SNAPSHOT) -> DataFrame:
    contract = inputs.order_contract(*rules, table_rules=table_rules)
    return _results(quality.evaluate(inputs.quality_orders(spark, folder), compile_rules(contract, standard)))


def rule(metric, **more):
    comparison = {} if any(k.startswith("must") for k in more) else {"mustBe": 0}
    return {"metric": metric, **comparison, **more}


@query
def dq_null_values(spark, folder):
    return _orders(
        spark,
        folder,
        ("o_orderstatus", rule("nullValues", id="status-null", severity="error")),
        ("o_custkey", rule("nullValues")),
    )


@query
def dq_missing_values(spark, folder):
    return _orders(
        spark,
        folder,
        ("o_orderpriority", rule("missingValues", id="default")),
        ("o_orderstatus", rule("missingValues", id="listed", arguments={"missingValues": ["P", 3, None]})),
        ("o_custkey", rule("missingValues", id="number", arguments={"missingValues": [1, 2, "x"]})),
    )


@query
def dq_valid_values(spark, folder):
    rows = table(spark, folder, "customer")
    listed = {"validValues": ["BUILDING", "MACHINERY", "HOUSEHOLD", 7]}
    contract = Contract(
        "customer",
        (
            Column("c_custkey", "BIGINT", quality=(rule("invalidValues", id="none", arguments={"validValues": ["a"]}),)),
            Column("c_mktsegment", "STRING", quality=(rule("invalidValues", id="segment", arguments=listed),)),
        ),
    )
    return _results(quality.evaluate(rows, compile_rules(contract, SNAPSHOT)))


@query
def dq_pattern(spark, folder):
    return _orders(
        spark, folder, ("o_orderpriority", rule("invalidValues", id="form", arguments={"pattern": "[1-4]-[A-Z]+"}))
    )


@query
def dq_duplicate_column(spark, folder):
    return _orders(
        spark,
        folder,
        ("o_custkey", rule("duplicateValues", id="customer")),
        ("o_orderstatus", rule("duplicateValues", id="status", unit="percent", mustBeLessThan=90)),
    )


@query
def dq_duplicate_composite(spark, folder):
    pair = {"properties": ["o_custkey", "o_orderstatus"]}
    return _orders(spark, folder, table_rules=[rule("duplicateValues", id="pair", arguments=pair, severity="error")])


@query
def dq_row_count(spark, folder):
    return _orders(spark, folder, table_rules=[rule("rowCount", id="rows", mustBeGreaterThan=10, unit="percent")])


@query
def dq_sql_rule(spark, folder):
    rules = [
        {"id": "large", "type": "sql", "query": "SELECT count(*) FROM ${table} WHERE o_totalprice > 250000", "mustBe": 0},
        {"id": "top", "type": "sql", "query": "SELECT max(o_totalprice) FROM ${table}", "mustBeLessThan": 1000000.5},
    ]
    column = {"id": "length", "type": "sql", "query": "SELECT max(length(${column})) FROM ${table}", "mustBeLessOrEqualTo": 10}
    return _orders(spark, folder, ("o_orderpriority", column), table_rules=rules)


@query
def dq_predicate(spark, folder):
    rules = [
        {"id": "status", "type": "custom", "engine": "spark", "implementation": "o_orderstatus = 'F' OR o_custkey > 100"},
        {"id": "other-engine", "type": "custom", "engine": "soda", "implementation": "x"},
    ]
    return _orders(spark, folder, table_rules=rules)


@query
def dq_key_rules(spark, folder):
    contract = Contract(
        "lineitem",
        (Column("l_orderkey", "BIGINT", key=True), Column("l_linenumber", "INT", key=True), Column("l_quantity", "DOUBLE")),
    )
    return _results(quality.evaluate(table(spark, folder, "lineitem"), compile_rules(contract, MANAGED)))


@query
def dq_percent(spark, folder):
    return _orders(
        spark, folder, ("o_orderstatus", rule("nullValues", id="share", unit="percent", mustBeBetween=[10, 20]))
    )


@query
def dq_operators(spark, folder):
    comparisons = {
        "mustBe": 3,
        "mustNotBe": 3,
        "mustBeGreaterThan": 1000,
        "mustBeGreaterOrEqualTo": 1000,
        "mustBeLessThan": 1000,
        "mustBeLessOrEqualTo": 1000.5,
        "mustBeBetween": [1, 1000000],
        "mustNotBeBetween": [1, 1000000],
    }
    rules = [("o_orderstatus", {"metric": "nullValues", "id": o, o: threshold}) for o, threshold in comparisons.items()]
    return _orders(spark, folder, *rules)


@query
def dq_date_allow_list(spark, folder):
    days = ["1998-01-01", "1998-02-30", "1999-12-31", "1998-01-02 ", 5]
    times = ["1998-01-01 00:00:00", "1999-01-01T00:00:00.000", "1998-01-01T00:00:00Z"]
    return _orders(
        spark,
        folder,
        ("o_day", rule("invalidValues", id="days", arguments={"validValues": days})),
        ("o_orderdate", rule("invalidValues", id="times", arguments={"validValues": times})),
    )


@query
def dq_event_waiver(spark, folder):
    contract = inputs.feed_contract(
        ("value", rule("nullValues", id="value")),
        ("event_type", rule("invalidValues", id="type", arguments={"validValues": ["view", "click"]})),
        ("event_id", rule("invalidValues", id="sequence", arguments={"validValues": [1, 2, 3]})),
    )
    feed = _events(spark, folder).withColumn("value", F.expr("CASE WHEN event_id % 5 <> 0 THEN value END"))
    rules = expectations(compile_rules(contract, EVENTS), ["user_id"], ["event_id"], "op")
    return count_failures(feed, {name: holds for name, (holds, _) in rules.items()})


@query
def dq_after_load(spark, folder):
    contract = Contract(
        "customer",
        (
            Column("c_custkey", "BIGINT", required=True, key=True),
            Column("c_acctbal", "DOUBLE", quality=(rule("nullValues", id="balance"),)),
            Column(
                "c_mktsegment",
                "STRING",
                quality=(rule("invalidValues", id="churn", arguments={"validValues": ["BUILDING", "CHURN"]}),),
            ),
        ),
        quality=(rule("rowCount", id="rows", mustBeGreaterThan=0),),
    )
    checks = compile_rules(contract, MANAGED)
    return _results(quality.check_table(scd2_snapshots(spark, folder), contract, checks, history=True))


@query
def freshness(spark, folder):
    now = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    return quality.fresh(table(spark, folder, "events"), "ts", 48, now)


# --- materialised views ----------------------------------------------------------------------

def _view(name):
    sources, columns, text = VIEWS[name]
    contract = Contract(name, tuple(Column(c, t) for c, t in columns.items()))

    def run(spark, folder):
        return sql_view(spark, text, {s: table(spark, folder, s) for s in sources}, contract)

    return run


QUERIES.update({name: _view(name) for name in VIEWS})


@query
def mv_python(spark, folder):
    contract = Contract(
        "languages", (Column("lang", "STRING"), Column("documents", "BIGINT"), Column("characters", "BIGINT"))
    )

    def transform(frames):
        return frames["documents"].groupBy("lang").agg(
            F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("characters")
        )

    return python_view(transform, {"documents": table(spark, folder, "documents")}, contract)
