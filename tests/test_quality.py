"""Quality rules over the given customers: every expected number is counted in plain Python from the same rows."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contractflow import Column, Contract, ContractError, DataRejected, QualityFailed
from contractflow.functions import rules as R
from contractflow.operators import quality

TYPES = {"c_custkey": "BIGINT", "c_nationkey": "INT", "c_mktsegment": "STRING", "c_acctbal": "DOUBLE"}


def described(table=(), everywhere=(), key=True, **by_column):
    """The customers' contract with rules on the table, on everything, and on columns; segments are published as ``segment``."""
    target = {"c_mktsegment": "segment"}
    columns = [Column(c, t, target.get(c), required=c == "c_custkey", key=key and c == "c_custkey", quality=tuple(by_column.get(c, ()))) for c, t in TYPES.items()]
    return Contract("customers", tuple(columns), "2.0.0", tuple(table), tuple(everywhere))


@pytest.fixture(scope="module")
def customers(spark):
    """Customers of which every seventh has no segment and the first ten stand twice."""
    rows = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    segment = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    rows = rows.select("c_custkey", "c_nationkey", segment.alias("segment"), "c_acctbal").orderBy("c_custkey")
    return rows.unionByName(rows.limit(10)).persist()


@pytest.fixture(scope="module")
def plain(customers):
    return [r.asDict() for r in customers.collect()]


def judged(frame, checks):
    return {r.id: (r.value, r.passed) for r in quality.evaluate(frame, checks).collect()}


def on(frame, standard=R.SNAPSHOT, **rules):
    return judged(frame, R.compile_rules(described(**rules), standard))


def rule(name, metric=None, **more):
    return {"id": name, **({"metric": metric} if metric else {}), **({} if set(more) & set(R.COMPARISONS) else {"mustBe": 0}), **more}


def test_single_value_rules_count_as_plain_python_does(customers, plain):
    listed = ["BUILDING", "MACHINERY", 7]
    rules = [
        rule("null", "nullValues"),
        rule("missing", "missingValues", arguments={"missingValues": ["BUILDING", 4]}),
        rule("missing-default", "missingValues"),
        rule("listed", "invalidValues", arguments={"validValues": listed}),
        rule("form", "invalidValues", arguments={"pattern": "[A-M].*"}),
        rule("nothing-valid", "invalidValues", arguments={"validValues": [1, 2]}),
    ]
    segments = [r["segment"] for r in plain]
    given = [s for s in segments if s is not None]
    wanted = {
        "null": segments.count(None),
        "missing": sum(s is None or s == "BUILDING" for s in segments),
        "missing-default": segments.count(None),
        "listed": sum(s not in listed for s in given),
        "form": sum(not re.fullmatch("[A-M].*", s) for s in given),
        "nothing-valid": len(given),
    }
    assert on(customers, c_mktsegment=rules) == {name: (str(n), n == 0) for name, n in wanted.items()}


def test_rules_on_the_table_count_as_plain_python_does(customers, plain):
    surplus = lambda values: sum(n - 1 for n in Counter(values).values())
    pairs = [(r["c_nationkey"], r["segment"]) for r in plain]
    balance = sum(r["c_acctbal"] < 0 for r in plain)
    found = on(
        customers,
        table=[
            rule("rows", "rowCount", mustBe=len(plain)),
            rule("pairs", "duplicateValues", arguments={"properties": ["c_nationkey", "segment"]}),
            rule("by-source-name", "duplicateValues", arguments={"properties": ["c_mktsegment"]}, unit="percent", mustBeBetween=[0, 100]),
            {"id": "positive", "type": "custom", "engine": "spark", "implementation": "c_acctbal >= 0"},
            {"id": "other-engine", "type": "custom", "engine": "great_expectations", "implementation": {}},
            {"id": "largest", "type": "sql", "query": "SELECT max(c_nationkey) FROM ${table}", "mustBe": max(r["c_nationkey"] for r in plain)},
        ],
        c_custkey=[rule("repeated", "duplicateValues")],
        c_mktsegment=[rule("share", "nullValues", unit="percent", mustBeLessThan=50), {"id": "longest", "type": "sql", "query": "SELECT max(length(${column})) FROM ${table}", "mustBe": 10}],
    )
    share = round(100 * sum(r["segment"] is None for r in plain) / len(plain), 4)
    assert found["rows"] == (str(len(plain)), True) and found["repeated"] == ("10", False)
    assert found["pairs"] == (str(surplus(pairs)), False)  # in a pair, nulls are equal
    assert float(found["by-source-name"][0]) == round(100 * surplus(r["segment"] for r in plain) / len(plain), 4)
    assert found["positive"] == (str(balance), balance == 0) and found["largest"][1] and found["longest"][1]
    assert float(found["share"][0]) == share and "other-engine" not in found


def test_null_values_are_no_duplicates_of_a_column(spark):
    frame = spark.createDataFrame([(1, 1, None, 0.0), (2, 1, None, 0.0), (3, 2, "A", 0.0)], "c_custkey bigint, c_nationkey int, segment string, c_acctbal double")
    found = on(frame, c_mktsegment=[rule("column", "duplicateValues")], table=[rule("table", "duplicateValues", arguments={"properties": ["segment"]})])
    assert found == {"column": ("0", True), "table": ("1", False)}


def test_many_duplicate_rules_are_one_scan(spark, customers, plain):
    """Grouping sets give what one grouping per rule gives: rules of the same columns, in other orders, and of one column twice."""
    pair = lambda name, *columns: rule(name, "duplicateValues", arguments={"properties": list(columns)})
    rules = {"table": [pair("ab", "c_nationkey", "segment"), pair("ba", "segment", "c_nationkey"), pair("a", "segment"), pair("abc", "segment", "c_nationkey", "c_acctbal")]}
    rules |= {"c_mktsegment": [rule("column", "duplicateValues"), rule("share", "duplicateValues", unit="percent")], "c_custkey": [rule("key", "duplicateValues")]}
    checks = R.compile_rules(described(**rules), R.SNAPSHOT)
    alone = {}
    for check in checks:
        alone |= judged(customers, [check])
    assert judged(customers, checks) == alone and alone["ab"] == alone["ba"] and alone["a"] != alone["column"]
    none = customers.limit(0)
    assert {v for v, _ in judged(none, checks).values()} == {"0"}
    plan = quality.evaluate(spark.read.parquet("/root/testdata/sf0.001/customer.parquet").withColumnRenamed("c_mktsegment", "segment"), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_nothing_to_judge(customers):
    none = customers.limit(0)
    found = on(none, table=[rule("rows", "rowCount")], c_mktsegment=[rule("share", "nullValues", unit="percent"), rule("twice", "duplicateValues")])
    assert found == {"rows": ("0", True), "share": ("0", True), "twice": ("0", True)}
    assert quality.evaluate(customers, []).collect() == []


def test_order_names_and_outcomes_of_compiled_rules():
    contract = described(
        everywhere=[rule("z", "rowCount", mustBeGreaterThan=0, severity="ERROR")], table=[{"metric": "rowCount", "mustNotBe": 5}],
        c_nationkey=[rule("a b", "nullValues", severity="error"), rule("a_b", "nullValues"), rule("a-b", "nullValues")],
    )
    checks = R.compile_rules(contract, R.SNAPSHOT)
    assert [(c.id, c.outcome, c.alias) for c in checks] == [
        ("z", "fail", "q_z"), ("customers.rowCount", "warn", "q_customers_rowCount"), ("a b", "fail", "q_a_b"), ("a_b", "warn", "q_a_b_2"), ("a-b", "warn", "q_a_b_3")
    ]


#: Comparison, a threshold that 160 meets, and one that it does not.
MET = {
    "mustBe": (160, 161), "mustNotBe": (161, 160), "mustBeGreaterThan": (159, 160), "mustBeGreaterOrEqualTo": (160, 161), "mustBeLessThan": (161, 160),
    "mustBeLessOrEqualTo": (160, 159), "mustBeBetween": ([160, 161], [1, 159]), "mustNotBeBetween": ([161, 170], [160, 160]),
}


def test_every_comparison(customers):
    checks = [R.Check(f"{name}-{met}", "rowCount", name, MET[name][not met]) for name in R.COMPARISONS for met in (True, False)]
    assert judged(customers, checks) == {c.id: ("160", c.id.endswith("True")) for c in checks}


def answer(frame, query, threshold=0, comparison="mustBe"):
    return judged(frame, [R.Check("asked", "sql", comparison, threshold, query=query)])["asked"]


@pytest.mark.parametrize("column", ["segment", "c_acctbal > 0", "CAST('inf' AS DOUBLE)", "float('nan')", "CAST(NULL AS DECIMAL(5,1))", "1, 2", "array(1)"])
def test_sql_rules_need_one_finite_number(customers, column):
    with pytest.raises(Exception, match="finite numeric value"):
        answer(customers, f"SELECT {column} FROM ${{table}} LIMIT 1")


def test_sql_rules_need_one_row(customers):
    for rows in ("c_custkey < 0", "c_custkey > 0"):
        with pytest.raises(Exception, match="finite numeric value"):
            answer(customers, f"SELECT c_custkey FROM ${{table}} WHERE {rows}")


def test_sql_answers_are_compared_exactly(customers):
    most = 2**63 - 1
    assert answer(customers, f"SELECT {most}", most) == (str(most), True) and not answer(customers, f"SELECT {most}", most - 1)[1]
    assert answer(customers, "SELECT 0.30", 0.3)[1] and answer(customers, "SELECT 0.3D", 0.3)[1]
    assert answer(customers, f"SELECT CAST({'8' * 38} AS DECIMAL(38,0))", 1, "mustBeGreaterThan") == ("8" * 38, True)


def test_no_view_of_the_data_stays_behind(spark, customers):
    before = {t.name for t in spark.catalog.listTables()}
    answer(customers, "SELECT count(*) FROM ${table}")
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_refusal_names_every_failed_rule(customers):
    required = [rule("no-null", "nullValues", severity="error"), rule("short", "invalidValues", severity="error", arguments={"pattern": "..."}), rule("warned", "nullValues")]
    found = quality.evaluate(customers, R.compile_rules(described(c_mktsegment=required), R.SNAPSHOT))
    with pytest.raises(QualityFailed, match="not applied: no-null, short$"):
        quality.enforce(found, quality.BEFORE_LOAD)
    with pytest.raises(QualityFailed, match="after load"):
        quality.enforce(found)
    with pytest.raises(ContractError):
        quality.enforce(found, "some other time")
    kept = quality.enforce(quality.evaluate(customers, R.compile_rules(described(c_mktsegment=required[2:]), R.SNAPSHOT)))
    assert [(r.id, r.passed) for r in kept] == [("warned", False)]
    many = [rule(f"r{i:02d}", "nullValues", severity="error") for i in range(14)]
    with pytest.raises(QualityFailed, match="r09 and 4 more"):
        quality.enforce(quality.evaluate(customers, R.compile_rules(described(c_mktsegment=many), R.SNAPSHOT)))


def test_stored_results_hold_counts_only(customers, plain):
    checks = R.compile_rules(described(c_mktsegment=[rule("listed", "invalidValues", arguments={"validValues": ["x"]}, severity="error")]), R.SNAPSHOT)
    row = quality.quality_results(quality.evaluate(customers, checks), {"run": "7"}, quality.AFTER_LOAD).first().asDict()
    assert row.pop("context") == {"run": "7"} and row.pop("enforcement") == quality.AFTER_LOAD
    assert row == {"id": "listed", "outcome": "fail", "value": str(sum(r["segment"] is not None for r in plain)), "passed": False}


def test_what_streams_can_enforce():
    whole = rule("whole", "rowCount", mustBeGreaterThan=0, severity="error")
    contract = described(table=[whole], c_nationkey=[rule("each", "nullValues"), {"id": "asked", "type": "sql", "query": "SELECT 1", "mustBe": 1}])
    assert [c.id for c in R.compile_rules(contract, R.EVENTS)] == ["each"] and R.not_enforced(contract, R.APPEND) == ["whole", "asked"]
    with pytest.raises(ContractError, match="cannot be enforced by append: whole"):
        R.compile_rules(contract, R.APPEND, unsupported="error")
    for comparison in ({"mustBe": 3}, {"mustBeLessOrEqualTo": 0}):
        with pytest.raises(ContractError, match="mustBe: 0"):
            R.compile_rules(described(c_nationkey=[rule("each", "nullValues", **comparison)]), R.EVENTS)


def test_keys_imply_rules_after_load(customers):
    names = lambda contract, standard: [c.id for c in R.compile_rules(contract, standard)]
    null, unique = "customers.c_custkey.key-not-null", "customers.key-unique"
    assert names(described(), R.SNAPSHOT) == [] and names(described(), R.VIEW) == [null, unique] and names(described(key=False), R.MANAGED) == []
    own = rule("own", "duplicateValues", arguments={"properties": ["c_custkey"]})
    assert names(described(table=[own]), R.MANAGED) == ["own", null]
    assert on(customers, R.MANAGED) == {null: ("0", True), unique: ("10", False)}


def test_listed_dates_match_files_but_not_tables(spark):
    days = rule("day", "invalidValues", arguments={"validValues": ["1996-02-29", "1997-02-29"]})
    contract = Contract("days", (Column("day", "DATE", quality=(days,)),))
    frame = spark.createDataFrame([(dt.date(1996, 2, 29),), (dt.date(1997, 3, 1),), (None,)], "day date")
    assert [judged(frame, R.compile_rules(contract, s))["day"][0] for s in (R.SNAPSHOT, R.VIEW)] == ["1", "2"]


UNUSABLE = {
    "semicolons": [{"type": "sql", "query": "SELECT 1; DROP TABLE x", "mustBe": 1}, {"type": "custom", "engine": "spark", "implementation": "c_acctbal > 0;"}],
    "comments": [{"type": "sql", "query": "SELECT 1 -- one", "mustBe": 1}, {"type": "custom", "engine": "databricks", "implementation": "true /* so */"}],
    "SELECT or WITH": [{"type": "sql", "query": q, "mustBe": 1} for q in ("VALUES (1)", "TABLE ${table}", "SHOW TABLES", "DELETE FROM ${table}", "FROM ${table} SELECT 1")],
    "as a query": [{"type": "sql", "query": q, "mustBe": 1} for q in ("SELECT", "SELECT 1) UNION (SELECT 2", "WITH x AS (DELETE FROM t) SELECT 1")],
    "without subqueries": [{"type": "custom", "engine": "spark", "implementation": p} for p in ("c_acctbal IN (SELECT 1)", "EXISTS (SELECT 1)", "c_acctbal > (SELECT 1)")],
    "as a predicate": [{"type": "custom", "engine": "spark", "implementation": p} for p in ("c_acctbal >", "1) OR (2", "SELECT 1 FROM x")],
    "SQL text is missing": [{"type": "sql", "query": " ", "mustBe": 1}, {"type": "custom", "engine": "spark", "implementation": 5}],
    "one comparison": [{"metric": "rowCount"}, {"metric": "rowCount", "mustBe": 1, "mustBeLessThan": 2}, {"type": "sql", "query": "SELECT 1"}],
    "two numbers": [{"metric": "rowCount", "mustBeBetween": [1]}, {"metric": "rowCount", "mustNotBeBetween": [1, "2"]}],
    "finite": [{"metric": "rowCount", "mustBe": v} for v in (float("inf"), False, "3", [1])],
    "needs a column": [{"metric": "missingValues", "mustBe": 0}],
    "properties": [{"metric": "duplicateValues", "mustBe": 0}],
    "unknown contract column": [{"metric": "duplicateValues", "mustBe": 0, "arguments": {"properties": ["c_name"]}}],
    "unsupported": [{"metric": "freshness", "mustBe": 0}],
}


@pytest.mark.parametrize("message", UNUSABLE)
def test_unusable_rules_are_refused(spark, message):
    for unusable in UNUSABLE[message]:
        with pytest.raises(ContractError, match=message):
            R.compile_rules(described(table=[unusable]), R.SNAPSHOT)


def test_words_in_quotes_are_no_statements(customers):
    query = "SELECT count_if(segment = 'drop; -- it' OR segment = \"/* x */\") FROM ${table}"
    assert on(customers, table=[{"id": "quoted", "type": "sql", "query": query, "mustBe": 0}])["quoted"] == ("0", True)
    named = "`delete` > 0 AND segment <> 'insert into'"
    assert on(customers.withColumn("delete", F.lit(1)), table=[{"id": "p", "type": "custom", "engine": "spark", "implementation": named}])["p"][0].isdigit()


def test_structure_of_a_table_comes_before_its_rules(spark, customers):
    contract = described(key=False, c_mktsegment=[rule("null", "nullValues")])
    checks = R.compile_rules(contract, R.MANAGED)
    table = customers.withColumns({"__START_AT": F.lit(1), "__END_AT": F.when(F.col("segment").isNull(), 2)})
    assert quality.check_table(table, contract, checks, history=True).first().passed  # rows without a segment are closed
    assert not quality.check_table(customers, contract, checks).first().passed
    with pytest.raises(ContractError, match="__END_AT"):
        quality.check_table(customers, contract, checks, history=True)
    for other in (customers.drop("c_acctbal"), customers.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))):
        with pytest.raises(DataRejected):
            quality.check_table(other, contract, checks)
    with pytest.raises(DataRejected, match="Required"):
        quality.check_table(customers.withColumn("c_custkey", F.when(F.col("c_custkey") != 3, F.col("c_custkey"))), contract, checks)


def test_freshness_of_the_newest_value(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderdate", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    newest = orders.agg(F.max("o_orderdate")).first()[0]
    now = newest.replace(tzinfo=dt.timezone.utc) + dt.timedelta(hours=30)
    assert [quality.fresh(orders, "o_orderdate", h, now).first().fresh for h in (30, 29.99)] == [True, False]
    midnight = dt.datetime.combine(newest.date(), dt.time(), dt.timezone.utc) + dt.timedelta(hours=5)
    assert [quality.fresh(orders, "day", h, midnight).first().fresh for h in (5, 4)] == [True, False]
    with pytest.raises(DataRejected):
        quality.require_fresh(orders.where("false"), "day", 10**6, now)
    with pytest.raises(ContractError):
        quality.fresh(orders, "o_orderstatus", 1, now)
