import datetime as dt

import pytest
from pyspark.sql import functions as F

from contractflow import Column, Contract, DataRejected
from contractflow.functions import temporal
from contractflow.operators.projection import TEMPORAL_FLAG, preflight_parquet, project, row_violations

CONTRACT = Contract(
    "orders",
    (
        Column("id", "BIGINT", key=True),
        Column("day", "DATE", required=True),
        Column("event", "TIMESTAMP", target="event_time"),
        Column("label", "STRING"),
    ),
)
TEXT = "id bigint, day string, event string, label string"


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland", "America/Los_Angeles"])
def test_valid_text_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame(
            [(1, "2024-02-29", "2024-03-10T02:30:00.123456", "x"), (2, "0001-01-01", "9999-12-31 23:59:59", None), (3, None, None, None)], TEXT
        )
        got = project(frame, CONTRACT, "json").select("day", F.col("event_time").cast("string")).orderBy("id").collect()
        assert [tuple(r) for r in got] == [
            (dt.date(2024, 2, 29), "2024-03-10 02:30:00.123456"),
            (dt.date(1, 1, 1), "9999-12-31 23:59:59"),
            (None, None),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "day,event",
    [
        ("2023-02-29", None),
        ("0000-01-01", None),
        ("2024-2-9", None),
        (" 2024-02-09", None),
        ("2024-02-09\n", None),
        ("2024-02-09T00:00:00", None),
        (None, "2024-02-29T01:02:03.1234567"),
        (None, "2024-02-29T01:02:03+13:00"),
        (None, "2024-02-29T01:02:03Z"),
        (None, "2024-02-29"),
        (None, "2024-02-30T01:02:03"),
        (None, "2024-02-29T24:02:03"),
        (None, "2024-02-29T01:02:60"),
        (None, "0000-02-29T01:02:03"),
        (None, ""),
    ],
)
def test_inexact_text_fails_without_its_value(spark, day, event):
    frame = spark.createDataFrame([(1, day, event, "secret-value")], TEXT)
    flagged = project(frame, CONTRACT, "json", on_invalid="report")
    assert flagged.first()[TEMPORAL_FLAG]
    with pytest.raises(Exception) as error:
        project(frame, CONTRACT, "json").collect()
    assert temporal.INVALID in str(error.value)
    assert "secret-value" not in str(error.value) and (day or event or "2024-02") not in str(error.value).split("SQLSTATE")[0]


def test_parquet_footers_are_checked_before_a_forced_schema(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    day = pa.array([dt.date(2024, 1, 1)])
    stamp = dt.datetime(2024, 1, 1)

    def write(name, kind, file="a.parquet"):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        table = pa.table({"id": pa.array([1]), "day": day, "event": pa.array([stamp], kind), "label": pa.array(["x"])})
        pq.write_table(table, folder / file)
        return str(folder)

    preflight_parquet(spark, write("good", pa.timestamp("us")), CONTRACT)
    zoned = write("zoned", pa.timestamp("us", tz="UTC"))
    nano = write("nano", pa.timestamp("ns"))
    write("mixed", pa.timestamp("us"))
    mixed = write("mixed", pa.timestamp("us", tz="UTC"), "b.parquet")
    for path in (zoned, nano, mixed):
        with pytest.raises(DataRejected):
            preflight_parquet(spark, path, CONTRACT)
    missing = tmp_path / "missing"
    missing.mkdir()
    pq.write_table(pa.table({"id": pa.array([1]), "event": pa.array([stamp], pa.timestamp("us"))}), missing / "a.parquet")
    with pytest.raises(DataRejected):
        preflight_parquet(spark, str(missing), CONTRACT)


def test_parquet_years_must_have_four_digits(spark):
    frame = spark.sql("SELECT 1L AS id, make_date(10000, 1, 1) AS day, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS event, 'x' AS label")
    assert frame.where(temporal.any_invalid(CONTRACT, "parquet")).count() == 1
    assert frame.withColumn("day", F.expr("DATE'9999-12-31'")).where(temporal.any_invalid(CONTRACT, "parquet")).count() == 0


def test_rule_literals_match_only_exact_text(spark):
    for bad in ["2024-02-29\n", "2024-02-30", "0000-01-01", "24-02-29", 5, None, "2024-02-29T00:00:00", "٢٠٢٤-02-29"]:
        assert temporal.literal("DATE", bad) is None
    for bad in [
        "2024-02-30T01:02:03", "2024-02-29T24:02:03", "2024-02-29T01:60:03", "2024-02-29T01:02:60",
        "2024-02-29T01:02:03Z", "2024-02-29T01:02:03.1234567", "2024-02-29T24:00:00", "2024-02-29",
    ]:
        assert temporal.literal("TIMESTAMP", bad) is None
    row = spark.range(1).select(
        temporal.literal("DATE", "2024-02-29").alias("d"), temporal.literal("TIMESTAMP", "2024-02-29T01:02:03.5").alias("t")
    ).first()
    assert tuple(row) == (dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 1, 2, 3, 500000))


def test_row_rules_count_null_as_failing_and_waive_deletes(spark, rows):
    contract = Contract(
        "t", (Column("k", "BIGINT", key=True), Column("v", "STRING", required=True), Column("op", "STRING"), Column("s", "BIGINT"))
    )
    frame = spark.createDataFrame([(1, None, "D", 1), (1, None, "U", 2), (None, "x", "D", 3), (2, "x", None, None)], "k bigint, v string, op string, s bigint")
    found = row_violations(frame, contract, expectations={"short": "length(v) < 3"}, sequence=["s"], operation="op")
    assert dict(rows(found)) == {"required.v": 1, "required.k": 1, "required.s": 1, "business.short": 2, "operation": 1}
    for text in ["a; b", "a -- b", "a /* b */", ""]:
        with pytest.raises(ValueError):
            row_violations(frame, contract, expectations={"bad": text})
