"""The same results in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from .inputs import HIGH_WATER_MARK
from .views import VIEWS

SNAPSHOTS = """
    v1 AS (SELECT * FROM customer WHERE c_custkey % 10 <> 9),
    v2 AS (SELECT c_custkey, c_name, c_nationkey,
                  CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
           FROM customer WHERE c_custkey % 7 <> 3),
    v3 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                  CASE WHEN c_custkey % 11 = 0 THEN 'CHURN' ELSE c_mktsegment END AS c_mktsegment FROM customer)"""
CUSTOMER = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

FEED = """(SELECT user_id, event_id, ts,
                  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op, event_type, value
           FROM events)"""


def _struct(columns):
    return "struct_pack(" + ", ".join(f"{c} := {c}" for c in columns) + ")"


def _history(rows, keys, payload, tracked, start="__START_AT", end="__END_AT", ctes=""):
    """SCD2 of ``rows`` with columns keys, seq, op and payload."""
    key = ", ".join(keys)
    return f"""
    WITH {ctes} e AS (SELECT {key}, seq, op, {_struct(payload)} AS body, {_struct(tracked)} AS state FROM ({rows}) q),
    l AS (SELECT *, lag(op) OVER w AS before_op, lag(state) OVER w AS before_state FROM e
          WINDOW w AS (PARTITION BY {key} ORDER BY seq)),
    b AS (SELECT *, CASE WHEN before_op IS NULL OR (op = 'D') <> (before_op = 'D')
                           OR (op <> 'D' AND state IS DISTINCT FROM before_state) THEN 1 ELSE 0 END AS chg FROM l),
    i AS (SELECT *, sum(chg) OVER (PARTITION BY {key} ORDER BY seq) AS run FROM b),
    r AS (SELECT {key}, run, min(seq) AS s, bool_and(op <> 'D') AS alive, last(body ORDER BY seq) AS body
          FROM i GROUP BY {key}, run),
    n AS (SELECT *, lead(s) OVER (PARTITION BY {key} ORDER BY s) AS e FROM r)
    SELECT {key}, {", ".join(f"body.{c} AS {c}" for c in payload)}, s AS {start}, e AS {end} FROM n WHERE alive"""


def _snapshots(versions, tracked):
    """Snapshots as events: a key that a version lacks is a delete at that version."""
    grid = f"""SELECT k.c_custkey, v.version AS seq, CASE WHEN s.version IS NULL THEN 'D' ELSE 'U' END AS op,
                      {", ".join("s." + c for c in CUSTOMER)}
               FROM (SELECT DISTINCT c_custkey FROM d) k CROSS JOIN (SELECT DISTINCT version FROM d) v
               LEFT JOIN d s ON s.c_custkey = k.c_custkey AND s.version = v.version"""
    union = " UNION ALL ".join(f"SELECT *, CAST({n} AS BIGINT) AS version FROM {name}" for n, name in versions)
    return _history(grid, ["c_custkey"], CUSTOMER, tracked, ctes=f"{SNAPSHOTS}, d AS ({union}),")


THREE = [(1, "v1"), (2, "v2"), (3, "v3")]
FEED_ROWS = f"SELECT user_id, event_id AS seq, op, event_type, value FROM {FEED} f"

ORDERS = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS o_orderstatus,
                    o_totalprice, o_orderdate, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority,
                    CAST(o_orderdate AS DATE) AS o_day FROM orders)"""

CURSOR = """(SELECT o_orderkey, o_custkey, o_orderstatus,
                    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS cursor FROM orders)"""

RECEIPTS = """(SELECT 'retail.sales.o' || l_orderkey AS dataset,
        CASE WHEN l_partkey % 71 = 0 THEN '' WHEN l_partkey % 50 = 0 THEN 'd_fixed'
             ELSE 'd' || l_partkey || '_' || l_suppkey END AS id,
        CAST(l_linenumber AS BIGINT) AS version,
        CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE date_trunc('day', l_shipdate) END AS captured,
        strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00' || CASE WHEN l_suppkey % 29 = 0 THEN '' ELSE 'Z' END AS captured_at,
        CASE WHEN l_suppkey % 31 = 0 THEN '' ELSE '1.0.0' END AS contract_version,
        l_partkey % 37 <> 0 AND l_partkey % 43 <> 0 AS complete,
        CASE WHEN l_partkey % 61 = 0 THEN 0 WHEN l_partkey % 67 = 0 THEN -1
             ELSE CAST(l_quantity AS BIGINT) * 10 END AS row_count,
        CASE WHEN l_suppkey % 17 = 0 THEN '/landing/a/../run' WHEN l_suppkey % 19 = 0 THEN '/other/run'
             ELSE '/landing/run_' || l_partkey || '_' || l_suppkey END AS path
    FROM lineitem)"""

ORDERED = f"""(SELECT *, lag(version) OVER w AS before_version, lag(captured) OVER w AS before_captured,
        lag(row_count) OVER w AS before_rows FROM {RECEIPTS} r
    WINDOW w AS (PARTITION BY dataset ORDER BY version, captured NULLS FIRST, id))"""


def _broken(rules, source=RECEIPTS):
    return " UNION ALL ".join(
        f"SELECT dataset, version, '{rule}' AS rule FROM {source} r WHERE {condition}" for rule, condition in rules.items()
    )


def _check(rule, failing, outcome="warn", passed="value = 0", source=ORDERS):
    """Failing-row count of one rule."""
    return f"""SELECT '{rule}' AS id, '{outcome}' AS outcome, value, {passed} AS passed
               FROM (SELECT CAST(count(*) FILTER (WHERE {failing}) AS DOUBLE) AS value FROM {source} s) v"""


def _metric(rule, value, outcome="warn", passed="value = 0", source=ORDERS):
    return f"""SELECT '{rule}' AS id, '{outcome}' AS outcome, value, {passed} AS passed
               FROM (SELECT CAST({value} AS DOUBLE) AS value FROM {source} s) v"""


def _all(*parts):
    return " UNION ALL ".join(parts)


def _count(rule, failing, source):
    return f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {failing}) AS violations FROM {source} s"


DAY = """CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 1 THEN '2023-02-29' WHEN 2 THEN '0000-01-01'
         WHEN 3 THEN NULL WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') || chr(10)
         WHEN 5 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
EVENT = """strftime(o_orderdate, '%Y-%m-%d') || CASE o_orderkey % 8 WHEN 0 THEN 'T01:02:03.1234567'
           WHEN 1 THEN 'T01:02:03+13:00' WHEN 2 THEN 'T01:02:03Z' WHEN 3 THEN 'T25:02:03' WHEN 4 THEN 'T01:02:03.123456'
           WHEN 5 THEN ' 01:02:03' WHEN 6 THEN '' ELSE 'T01:02:03.5' END"""


def _strict(column, text, form, kind):
    valid = f"(regexp_full_match(t, '{form}') AND substr(t, 1, 4) <> '0000' AND try_cast(replace(t, 'T', ' ') AS {kind}) IS NOT NULL)"
    return f"""SELECT o_orderkey, CASE WHEN {valid} THEN try_cast(replace(t, 'T', ' ') AS {kind}) END AS {column},
                      t IS NOT NULL AND NOT {valid} AS _temporal_invalid
               FROM (SELECT o_orderkey, {text} AS t FROM orders) x"""


_ALL = _snapshots(THREE, CUSTOMER)
_TRACKED = _snapshots(THREE, ["c_mktsegment"])
_ROW = ["c_custkey", *CUSTOMER, "__START_AT", "__END_AT"]
_OPEN_ROWS = f"(SELECT * FROM ({_ALL}) h WHERE __END_AT IS NULL)"
_CHANGED_FEED = f"""(SELECT user_id, event_id, CASE WHEN event_id % 101 = 0 THEN 'X' ELSE op END AS op, event_type,
                            CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM {FEED} f)"""
_WAIVED_FEED = f"(SELECT *, CASE WHEN event_id % 5 <> 0 THEN value END AS kept FROM {FEED} f)"

SQL = {
    "scd2_snapshots": _ALL,
    "scd2_snapshots_tracked": _TRACKED,
    "scd2_snapshots_stepwise": _ALL,
    "current_from_history": f"SELECT c_custkey, {', '.join(CUSTOMER)} FROM {_OPEN_ROWS} o",
    "snapshot_diff": f"""WITH {SNAPSHOTS}
        SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
               CASE WHEN a.c_custkey IS NULL THEN 'insert' WHEN b.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS change
        FROM v1 a FULL OUTER JOIN v2 b ON a.c_custkey = b.c_custkey
        WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL
           OR (a.c_name, a.c_nationkey, a.c_acctbal, a.c_mktsegment)
              IS DISTINCT FROM (b.c_name, b.c_nationkey, b.c_acctbal, b.c_mktsegment)""",
    "scd2_events": _history(FEED_ROWS, ["user_id"], ["event_type", "value"], ["event_type", "value"]),
    "scd2_events_tracked": _history(FEED_ROWS, ["user_id"], ["event_type", "value"], ["event_type"]),
    "scd2_composite_key": _history(
        "SELECT user_id, event_type, event_id AS seq, CASE WHEN event_id % 11 = 0 THEN 'D' ELSE 'U' END AS op, value FROM events",
        ["user_id", "event_type"],
        ["value"],
        ["value"],
    ),
    "scd2_struct_sequence": "SELECT user_id, event_type, value, s.ts AS start_ts, s.event_id AS start_id, "
    "e.ts AS end_ts, e.event_id AS end_id FROM ("
    + _history(
        f"SELECT user_id, struct_pack(ts := ts, event_id := event_id) AS seq, op, event_type, value FROM {FEED} f",
        ["user_id"],
        ["event_type", "value"],
        ["event_type", "value"],
        "s",
        "e",
    )
    + ") h",
    "sequence_conflicts": """SELECT l_orderkey, l_linenumber, count(*) AS events FROM lineitem
        GROUP BY l_orderkey, l_linenumber
        HAVING count(DISTINCT struct_pack(a := l_partkey, b := l_suppkey, c := l_quantity, d := l_extendedprice,
            e := l_discount, f := l_tax, g := l_returnflag, h := l_linestatus, i := l_shipdate)) > 1""",
    "scd1_upsert": """SELECT user_id, ts, event_type, value, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
            AND NOT (event_id % 2 = 1 AND event_type = 'error')""",
    "scd2_cursor": _history(
        "SELECT user_id, ts AS seq, 'U' AS op, ts, event_type, value FROM events",
        ["user_id"],
        ["ts", "event_type", "value"],
        ["event_type", "value"],
    ),
    "full_refresh_scd2": _snapshots([(1, "v1"), (2, "v3")], CUSTOMER),
    "history_reconcile": f"""SELECT {', '.join(_ROW)}, CAST(sum(n) AS BIGINT) AS copies FROM (
        SELECT {', '.join(_ROW)}, 1 AS n FROM ({_ALL}) a UNION ALL SELECT {', '.join(_ROW)}, -1 FROM ({_TRACKED}) b) u
        GROUP BY ALL HAVING sum(n) <> 0""",
    "cursor_increment": f"SELECT * FROM {CURSOR} c WHERE cursor > TIMESTAMP '{HIGH_WATER_MARK}'",
    "append_only_increment": f"SELECT * FROM {CURSOR} c WHERE cursor IS NOT NULL",
    "cursor_hwm": f"SELECT max(cursor) AS high_water_mark FROM {CURSOR} c",
    "include_columns": "SELECT p_partkey, p_brand, p_size FROM part",
    "column_mapping_swap": "SELECT event_id, event_type AS props, props AS event_type FROM events",
    "strict_date_parse": _strict("day", DAY, "[0-9]{4}-[0-9]{2}-[0-9]{2}", "DATE"),
    "strict_ts_parse": _strict(
        "event", EVENT, "[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?", "TIMESTAMP"
    ),
    "required_violations": _all(
        _count("required.user_id", "user_id IS NULL", _CHANGED_FEED),
        _count("required.value", "NOT coalesce(op = 'D' OR value IS NOT NULL, false)", _CHANGED_FEED),
        _count("required.event_id", "event_id IS NULL", _CHANGED_FEED),
        _count("operation", "op NOT IN ('I', 'U', 'D')", _CHANGED_FEED),
    ),
    "business_expectation": _all(
        _count("required.o_orderkey", "o_orderkey IS NULL", ORDERS),
        _count("business.positive", "NOT coalesce(o_totalprice > 1000, false)", ORDERS),
        _count("business.known", "NOT coalesce(o_orderstatus IN ('O', 'F'), false)", ORDERS),
    ),
    "rescued_json": """SELECT event_id,
        CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 1 WHEN event_id % 19 = 0 THEN NULL
             ELSE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS k,
        CASE WHEN event_id % 13 = 0 THEN '{"k": "x"}' WHEN event_id % 17 = 0 THEN '{"k": 1, "z": 2}'
             WHEN event_id % 19 = 0 THEN '{"k": ' END AS _rescued_data
        FROM events""",
    "ledger_pending": f"""SELECT dataset, version, id FROM (
        SELECT r.*, row_number() OVER (PARTITION BY r.dataset ORDER BY version, id) AS n FROM {RECEIPTS} r
        LEFT JOIN (SELECT 'retail.sales.o' || o_orderkey AS dataset, o_orderkey % 5 AS latest FROM orders
                   WHERE o_orderkey % 3 <> 0) l ON l.dataset = r.dataset
        WHERE latest IS NULL OR version > latest) x WHERE n = 1""",
    "ledger_bad_receipts": _broken(
        {
            "id": "NOT regexp_full_match(id, '[A-Za-z0-9_-]{1,128}')",
            "row_count": "row_count < 0",
            "captured_at": "captured IS NULL",
            "contract_version": "contract_version = ''",
            "complete": "NOT complete",
        }
    ),
    "ledger_duplicates": f"""SELECT dataset, min(version) AS version, 'duplicate_' || field AS rule, count(*) AS copies
        FROM (SELECT dataset, version, 'id' AS field, id AS value FROM {RECEIPTS} a
              UNION ALL SELECT dataset, version, 'version', CAST(version AS VARCHAR) FROM {RECEIPTS} b
              UNION ALL SELECT dataset, version, 'path', path FROM {RECEIPTS} c) u
        GROUP BY dataset, field, value HAVING count(*) > 1""",
    "ledger_paths": _broken({"path": "NOT regexp_full_match(path, '/landing/[A-Za-z0-9_-]{1,128}')"}),
    "ledger_gaps": _broken({"gap": "version <> coalesce(before_version, 0) + 1 AND version IS DISTINCT FROM before_version"}, ORDERED),
    "ledger_time_order": _broken({"time_order": "captured < before_captured"}, ORDERED),
    "ledger_drop_percent": _broken(
        {"drop_percent": "before_rows <> 0 AND 100.0 * (before_rows - row_count) / nullif(before_rows, 0) > 60"}, ORDERED
    ),
    "ledger_row_policy": _broken({"minimum_rows": "row_count < 50", "empty": "row_count = 0"}),
    "ledger_stale": f"""SELECT dataset, version, 'stale' AS rule FROM (
        SELECT dataset, version, max(captured) AS captured,
               row_number() OVER (PARTITION BY dataset ORDER BY version DESC) AS n
        FROM {RECEIPTS} r GROUP BY dataset, version) x
        WHERE n = 1 AND captured < TIMESTAMP '2002-01-01' - INTERVAL 17520 HOURS""",
    "ledger_contract_mismatch": f"""SELECT dataset, version, 'contract_mismatch' AS rule FROM (
        SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY version, id, captured_at, contract_version) AS n
        FROM {RECEIPTS} r) x WHERE n = 1 AND contract_version <> '1.0.0'""",
    "key_uniqueness": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_null_values": _all(
        _check("status-null", "o_orderstatus IS NULL", "fail"), _check("orders.o_custkey.nullValues", "o_custkey IS NULL")
    ),
    "dq_missing_values": _all(
        _check("default", "o_orderpriority IS NULL OR o_orderpriority = ''"),
        _check("listed", "o_orderstatus IS NULL OR o_orderstatus = 'P'"),
        _check("number", "o_custkey IS NULL OR o_custkey IN (1, 2)"),
    ),
    "dq_valid_values": _all(
        _check("none", "c_custkey IS NOT NULL", source="customer"),
        _check("segment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')", source="customer"),
    ),
    "dq_pattern": _check("form", "NOT regexp_full_match(o_orderpriority, '[1-4]-[A-Z]+')"),
    "dq_duplicate_column": _all(
        _metric("customer", "count(o_custkey) - count(DISTINCT o_custkey)"),
        _metric(
            "status",
            "round(100.0 * (count(o_orderstatus) - count(DISTINCT o_orderstatus)) / count(*), 4)",
            passed="value < 90",
        ),
    ),
    "dq_duplicate_composite": _metric(
        "pair", "count(*) - count(DISTINCT struct_pack(a := o_custkey, b := o_orderstatus))", "fail"
    ),
    "dq_row_count": _metric("rows", "count(*)", passed="value > 10"),
    "dq_sql_rule": _all(
        _check("large", "o_totalprice > 250000"),
        _metric("top", "max(o_totalprice)", passed="value < 1000000.5"),
        _metric("length", "max(length(o_orderpriority))", passed="value <= 10"),
    ),
    "dq_predicate": _check("status", "NOT coalesce(o_orderstatus = 'F' OR o_custkey > 100, false)"),
    "dq_key_rules": _all(
        _check("lineitem.l_orderkey.key-not-null", "l_orderkey IS NULL", "fail", source="lineitem"),
        _check("lineitem.l_linenumber.key-not-null", "l_linenumber IS NULL", "fail", source="lineitem"),
        _metric(
            "lineitem.key-unique",
            "count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d)",
            "fail",
            source="lineitem",
        ),
    ),
    "dq_percent": _metric(
        "share",
        "round(100.0 * count(*) FILTER (WHERE o_orderstatus IS NULL) / count(*), 4)",
        passed="value BETWEEN 10 AND 20",
    ),
    "dq_operators": _all(
        *[
            _check(operator, "o_orderstatus IS NULL", passed=passed)
            for operator, passed in {
                "mustBe": "value = 3",
                "mustNotBe": "value <> 3",
                "mustBeGreaterThan": "value > 1000",
                "mustBeGreaterOrEqualTo": "value >= 1000",
                "mustBeLessThan": "value < 1000",
                "mustBeLessOrEqualTo": "value <= 1000.5",
                "mustBeBetween": "value BETWEEN 1 AND 1000000",
                "mustNotBeBetween": "value NOT BETWEEN 1 AND 1000000",
            }.items()
        ]
    ),
    "dq_date_allow_list": _all(
        _check("times", "o_orderdate NOT IN (TIMESTAMP '1998-01-01 00:00:00', TIMESTAMP '1999-01-01 00:00:00')"),
        _check("days", "o_day NOT IN (DATE '1998-01-01', DATE '1999-12-31')"),
    ),
    "dq_event_waiver": _all(
        _count("sequence", "event_id NOT IN (1, 2, 3)", _WAIVED_FEED),
        _count("type", "op <> 'D' AND event_type NOT IN ('view', 'click')", _WAIVED_FEED),
        _count("value", "op <> 'D' AND kept IS NULL", _WAIVED_FEED),
    ),
    "dq_after_load": _all(
        _metric("rows", "count(*)", passed="value > 0", source=_OPEN_ROWS),
        _check("balance", "c_acctbal IS NULL", source=_OPEN_ROWS),
        _check("churn", "c_mktsegment NOT IN ('BUILDING', 'CHURN')", source=_OPEN_ROWS),
        _check("customer.c_custkey.key-not-null", "c_custkey IS NULL", "fail", source=_OPEN_ROWS),
        _metric("customer.key-unique", "count(*) - count(DISTINCT c_custkey)", "fail", source=_OPEN_ROWS),
    ),
    "freshness": """SELECT max(ts) AS latest,
        coalesce(max(ts) >= TIMESTAMP '2024-02-01' - INTERVAL 48 HOURS, false) AS fresh FROM events""",
    "mv_lambda": """SELECT vec_id, CAST(len(list_filter(list_transform(embedding, lambda x: x * 2), lambda x: x > 0)) AS INTEGER)
        AS positive FROM embeddings""",
    "mv_python": """SELECT lang, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS characters
        FROM documents GROUP BY lang""",
}
SQL.update(
    flow_snapshots=SQL["scd2_snapshots"],
    flow_rebuild=SQL["scd2_snapshots"],
    flow_change_feed=SQL["scd2_events_tracked"],
    flow_append="SELECT o_orderkey, o_orderstatus AS status, o_orderdate FROM orders",
    flow_table_scd1="""SELECT user_id, ts, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""",
    flow_table_scd2=SQL["scd2_cursor"],
    flow_view=VIEWS["mv_aggregate"][2],
)
SQL["ledger_audit"] = f"""SELECT rule, count(*) AS violations FROM (
    {" UNION ALL ".join(
        f"SELECT rule FROM ({SQL[name]}) x{name}"
        for name in (
            "ledger_bad_receipts", "ledger_duplicates", "ledger_paths", "ledger_gaps", "ledger_time_order",
            "ledger_drop_percent", "ledger_row_policy", "ledger_stale",
        )
    )}) u GROUP BY rule"""
for _name, (_sources, _columns, _text) in VIEWS.items():
    SQL.setdefault(_name, _text)
