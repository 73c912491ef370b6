import pytest
from pyspark.sql import functions as F

from contractflow import Column, Contract, ContractError, Dataset, QualityFailed, materialize, python_view, read_dataset, sql_view
from contractflow.plans.views import _checked_query

REPORT = Contract(
    "report",
    (Column("id", "BIGINT", required=True, key=True), Column("total", "BIGINT")),
    quality=({"id": "nonempty", "metric": "rowCount", "mustBeGreaterThan": 0, "severity": "error"},),
)


@pytest.fixture
def inputs(spark):
    return {
        "orders": spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "id bigint, value bigint"),
        "customers": spark.createDataFrame([(1, "a")], "id bigint, name string"),
    }


@pytest.mark.parametrize(
    "query",
    [
        "select id, value from orders",
        "SELECT o.id, max(o.value) OVER (PARTITION BY o.id ORDER BY o.value) FROM orders o LEFT JOIN customers c ON c.id = o.id",
        "WITH small AS (SELECT * FROM orders WHERE value < 7), both AS (SELECT * FROM small) SELECT id, value FROM both",
        "SELECT id, value FROM (WITH once AS (SELECT DISTINCT id, value FROM orders) SELECT * FROM once) t "
        "UNION ALL SELECT id, id FROM customers",
        "SELECT id, aggregate(transform(sequence(1L, value), n -> n * 2), 0L, (a, n) -> a + n) FROM orders",
        "SELECT id, value FROM `ORDERS` o WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.id = o.id)",
        "SELECT id, value FROM orders WHERE value IN (SELECT max(value) FROM orders GROUP BY id);",
        "SELECT id, value -- a note; with a semicolon\nFROM orders",
        "SELECT id, CAST(length('🦆; DROP') AS BIGINT) FROM orders",
    ],
)
def test_queries_over_declared_inputs(spark, inputs, query):
    result = sql_view(spark, query, inputs, REPORT)
    assert result.columns == ["id", "total"] and result.count() > 0


@pytest.mark.parametrize(
    "query",
    [
        "   ",
        "-- nothing here",
        "SELECT id FROM",
        "SELECT id, value FROM orders /* open",
        "SELECT id, value FROM orders; SELECT 1",
        "INSERT OVERWRITE orders SELECT 1, 1",
        "UPDATE orders SET value = 1",
        "CREATE VIEW copy AS SELECT * FROM orders",
        "SHOW TABLES",
        "SELECT id, value FROM default.orders",
        "SELECT id, value FROM customers",
        "SELECT id, value FROM json.`/tmp/x`",
        "SELECT id, value FROM IDENTIFIER('ord' || 'ers')",
        "SELECT TRANSFORM(id, value) USING 'tee' FROM orders",
        "SELECT id, value FROM orders VERSION AS OF 3",
        "SELECT * FROM orders PIVOT (max(value) FOR id IN (1, 2))",
        "WITH orders AS (SELECT 1L AS id, 1L AS value) SELECT * FROM orders",
        "WITH a AS (SELECT * FROM b), b AS (SELECT * FROM orders) SELECT id, value FROM a",
        "SELECT id, value FROM orders WHERE id IN (SELECT id FROM hidden)",
    ],
)
def test_anything_else_is_refused(spark, inputs, query):
    spark.sql("SELECT 1L AS id, 1L AS value").createOrReplaceTempView("hidden")
    with pytest.raises(Exception):
        sql_view(spark, query, {"orders": inputs["orders"]}, REPORT)


@pytest.mark.parametrize(
    "query",
    [
        "SELECT id, value FROM secret",
        "SELECT id, value FROM spark_catalog.default.secret",
        "SELECT id, value FROM orders JOIN global_temp.other USING (id, value)",
        "SELECT id, id AS value FROM range(3)",
        "WITH orders(id, value) AS (SELECT 1L, 2L) SELECT * FROM orders",
        "WITH secret AS (SELECT 1L AS id, 2L AS value) SELECT * FROM secret",
        "SELECT id, value FROM (SELECT '--' AS x, * FROM orders) PIVOT (max(id) FOR value IN (1))",
        "SELECT id, value FROM orders WHERE id IN (WITH z AS (SELECT id FROM secret) SELECT id FROM z)",
        "SELECT '\\n:  CTE [secret]' AS id, value FROM secret",
    ],
)
def test_existing_tables_that_are_not_declared_are_refused(spark, inputs, query):
    spark.sql("SELECT 1L AS id, 1L AS value").write.mode("overwrite").saveAsTable("secret")
    spark.sql("SELECT 1L AS id, 1L AS value").createOrReplaceGlobalTempView("other")
    try:
        with pytest.raises(ContractError):
            sql_view(spark, query, {"orders": inputs["orders"]}, REPORT)
    finally:
        spark.sql("DROP TABLE secret")
        spark.catalog.dropGlobalTempView("other")


def test_many_ctes_and_any_nesting(spark, inputs):
    """Printed plans are cut; nodes are not."""
    chain = ", ".join(f"c{i} AS (SELECT * FROM {f'c{i - 1}' if i else 'orders'})" for i in range(60))
    assert sql_view(spark, f"WITH {chain} SELECT id, value FROM c59", inputs, REPORT).count() > 0
    spark.sql("SELECT 1L AS id, 1L AS value").createOrReplaceTempView("hidden")
    for last in ("c59 WHERE id IN (SELECT id FROM hidden)", "c59 ORDER BY (SELECT max(id) FROM hidden)", "c59 JOIN LATERAL (SELECT 1 FROM hidden) l"):
        with pytest.raises(ContractError, match="hidden is not a declared input"):
            sql_view(spark, f"WITH {chain} SELECT id, value FROM {last}", inputs, REPORT)


def test_input_names_are_distinct_and_text_is_kept(spark, inputs):
    with pytest.raises(ContractError):
        sql_view(spark, "SELECT 1", {"a": inputs["orders"], "A": inputs["orders"]}, REPORT)
    assert _checked_query(spark, "SELECT 'a;b' FROM orders ;", ["orders"]) == "SELECT 'a;b' FROM orders "
    with pytest.raises(ContractError, match="time travel"):
        _checked_query(spark, "SELECT * FROM orders TIMESTAMP AS OF '2024'", ["orders"])


def test_output_is_labelled_by_position_and_typed(spark, inputs):
    result = sql_view(spark, "SELECT value AS x, id AS y FROM orders", inputs, REPORT)
    assert result.columns == ["id", "total"] and result.agg(F.max("id")).first()[0] == 7
    for query in ["SELECT id FROM orders", "SELECT id, value, 1 FROM orders", "SELECT id, CAST(value AS INT) FROM orders"]:
        with pytest.raises(ContractError):
            sql_view(spark, query, inputs, REPORT)


def test_session_settings_reach_the_view(spark, inputs):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        result = sql_view(spark, "SELECT 1L, CAST(hour(timestamp_seconds(0)) AS BIGINT) FROM customers", inputs, REPORT)
        assert result.first().total == 12
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_python_views(spark, inputs):
    total = lambda frames: frames["orders"].groupBy("id").agg(F.sum("value").alias("total"))
    assert python_view(total, inputs, REPORT).count() == 2
    stream = spark.readStream.format("rate").load().selectExpr("value AS id", "value AS total")
    for bad in (lambda f: stream, lambda f: f["orders"], lambda f: None, lambda f: total(f).select("total", "id")):
        with pytest.raises(ContractError):
            python_view(bad, inputs, REPORT)
    with pytest.raises(ContractError):
        python_view(total, inputs, Contract("empty", ()))


def test_materialised_views_are_replaced_whole_and_checked(spark, inputs, tmp_path, rows):
    target = str(tmp_path / "report")
    grouped = "SELECT id, sum(value) FROM orders GROUP BY id"
    materialize(spark, sql_view(spark, grouped, inputs, REPORT), target, REPORT)
    assert rows(Dataset(spark, target).read()) == [(1, 11), (2, 7)]
    with pytest.raises(QualityFailed, match="report.key-unique"):
        materialize(spark, sql_view(spark, "SELECT * FROM orders", inputs, REPORT), target, REPORT)
    assert Dataset(spark, target).version().number == 2  # a failed check reports, it does not roll back
    with pytest.raises(QualityFailed, match="nonempty"):
        materialize(spark, sql_view(spark, grouped, {"orders": inputs["orders"].limit(0)}, REPORT), target, REPORT)


def test_views_over_views_and_tables(spark, inputs, tmp_path, rows):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    materialize(spark, sql_view(spark, "SELECT id, sum(value) FROM orders GROUP BY id", inputs, REPORT), first, REPORT)
    over = sql_view(spark, "SELECT id, total + 1 FROM report WHERE id = 1", {"report": read_dataset(spark, first)}, REPORT)
    materialize(spark, over, second, REPORT)
    assert rows(read_dataset(spark, second)) == [(1, 12)]
    inputs["orders"].createOrReplaceTempView("external_orders")
    assert read_dataset(spark, "external_orders").count() == 3
    with pytest.raises(ContractError):
        read_dataset(spark, first, "history")
    with pytest.raises(ContractError):
        read_dataset(spark, str(tmp_path / "nothing"))
