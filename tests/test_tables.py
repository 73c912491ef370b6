import datetime as dt

import pytest
from pyspark.sql import functions as F

from contractflow import Column, Contract, ContractError, DataRejected, Dataset, QualityFailed, TableFlow
from contractflow.contract import END_AT, START_AT
from contractflow.sources.files import below_root, read_folder
from contractflow.sources.tables import checked_rows, read_extract, read_query

CONTRACT = Contract(
    "orders", (Column("id", "BIGINT", required=True, key=True), Column("status", "STRING"), Column("at", "TIMESTAMP"))
)
SCHEMA = "id bigint, status string, at timestamp_ntz"


def at(day):
    return dt.datetime(2024, 1, day)


def flow(tmp_path, data, **settings):
    """A flow whose source is a frame that the test may change."""
    return TableFlow(str(tmp_path / "out"), CONTRACT, lambda spark, mark: data["frame"], **settings)


@pytest.fixture
def data(spark):
    return {"frame": spark.createDataFrame([(1, "a", at(1)), (2, "b", at(2)), (3, "c", None)], SCHEMA)}


def test_scd1_with_a_cursor(spark, tmp_path, data, rows):
    f = flow(tmp_path, data, cursor="at", deleted="status = 'gone'")
    assert f.run(spark).info == {"mark": "2024-01-02 00:00:00", "buckets": 64}
    data["frame"] = spark.createDataFrame([(1, "late", at(1)), (2, "new", at(5)), (4, "gone", at(6)), (1, "gone", at(7))], SCHEMA)
    f.run(spark)
    assert rows(Dataset(spark, f.target).read()) == [(2, "new", at(5))]
    assert Dataset(spark, f.target).version().info == {"mark": "2024-01-05 00:00:00", "buckets": 64}
    assert f.check(spark)


def test_scd2_with_a_cursor(spark, tmp_path, data, rows):
    f = flow(tmp_path, data, cursor="at", mode="SCD_TYPE_2")
    f.run(spark)
    data["frame"] = spark.createDataFrame([(1, "a", at(3)), (2, "new", at(5)), (2, "newer", at(6)), (9, "x", at(4))], SCHEMA)
    f.run(spark)
    f.run(spark)
    got = Dataset(spark, f.target).read("history")
    assert rows(got, "id", "status", START_AT, END_AT) == [
        (1, "a", at(1), None), (2, "b", at(2), at(5)), (2, "new", at(5), at(6)), (2, "newer", at(6), None), (9, "x", at(4), None)
    ]
    assert rows(Dataset(spark, f.target).read(), "id", "at") == [(1, at(3)), (2, at(6)), (9, at(4))]
    assert {r.id: r.passed for r in f.check(spark)} == {"orders.id.key-not-null": True, "orders.key-unique": True}


def test_append_only_with_a_cursor(spark, tmp_path, data, rows):
    f = flow(tmp_path, data, cursor="at", mode="APPEND_ONLY")
    f.run(spark)
    data["frame"] = data["frame"].union(spark.createDataFrame([(1, "again", at(9))], SCHEMA))
    f.run(spark)
    assert rows(Dataset(spark, f.target).read(), "id", "status") == [(1, "a"), (1, "again"), (2, "b")]
    with pytest.raises(QualityFailed):
        f.check(spark)


def test_full_refresh_without_a_cursor(spark, tmp_path, data, rows):
    one = flow(tmp_path / "one", data)
    two = flow(tmp_path / "two", data, mode="SCD_TYPE_2")
    for f in (one, two):
        f.run(spark)
    data["frame"] = spark.createDataFrame([(1, "a", at(1)), (2, "changed", at(2))], SCHEMA)
    for f in (one, two):
        f.run(spark)
    assert rows(Dataset(spark, one.target).read(), "id", "status") == [(1, "a"), (2, "changed")]
    assert rows(Dataset(spark, two.target).read("history"), "id", "status", START_AT, END_AT) == [
        (1, "a", 1, None), (2, "b", 1, 2), (2, "changed", 2, None), (3, "c", 1, 2)
    ]


def test_settings(tmp_path, data):
    for settings in [
        {"mode": "SCD_TYPE_3"},
        {"cursor": "unknown"},
        {"deleted": "true"},
        {"deleted": "true", "cursor": "at", "mode": "SCD_TYPE_2"},
    ]:
        with pytest.raises(ContractError):
            flow(tmp_path, data, **settings)
    keyless = Contract("t", (Column("id", "BIGINT"),))
    with pytest.raises(ContractError, match="primary keys"):
        TableFlow("out", keyless, None)
    TableFlow("out", keyless, None, mode="APPEND_ONLY")


DATABASE = Contract(
    "orders",
    (Column("ID", "BIGINT", key=True, target="id"), Column("STATUS", "STRING", target="status"), Column("AT", "TIMESTAMP", target="at")),
)


def test_loaded_tables_are_checked_and_read_beyond_the_mark(spark, tmp_path, rows):
    """The part of a database read that needs no database; no JDBC source is started here."""
    path = str(tmp_path / "table")
    data = [(1, "a", at(1), 1), (2, "b", at(2), 2), (3, "c", None, 3)]
    spark.createDataFrame(data, "ID bigint, STATUS string, AT timestamp_ntz, EXTRA int").write.parquet(path)
    mark = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    loaded = spark.read.parquet(path)
    frame = checked_rows(loaded, DATABASE, "AT", mark)
    assert rows(frame) == [(2, "b", at(2))]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(AT" in plan and "EXTRA" not in plan
    assert checked_rows(loaded, DATABASE).count() == 3
    for wrong in (Column("ID", "INT"), Column("MISSING", "INT")):
        with pytest.raises(DataRejected):
            checked_rows(loaded, Contract("orders", (wrong,)))


def test_database_settings_are_checked_before_any_connection(spark):
    with pytest.raises(ContractError):
        read_query(spark, "jdbc:none:", "ORDERS", DATABASE, cursor="unknown")
    with pytest.raises(ContractError, match="partition"):
        read_query(spark, "jdbc:none:", "ORDERS", DATABASE, partition={"column": "ID"})


def test_extracts_read_only_contract_columns(spark, tmp_path):
    path = str(tmp_path / "extract")
    spark.sql("SELECT 1L AS id, 'x' AS status, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS at, 5 AS more").write.parquet(path)
    frame = read_extract(spark.read.parquet(path), CONTRACT)
    assert frame.columns == ["id", "status", "at"]
    assert "more" not in frame._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ContractError):
        read_extract(spark.read.parquet(path), DATABASE)


FOLDER = Contract("t", (Column("id", "BIGINT"), Column("day", "DATE"), Column("label", "STRING", target="name")))
FILES = {
    "csv": "id,day,label\n1,2024-02-29,a\n",
    "json": '{"id": 1, "day": "2024-02-29", "label": "a", "undeclared": 5}\n',
    "xml": "<rows><row><id>1</id><day>2024-02-29</day><label>a</label></row></rows>",
}


@pytest.mark.parametrize("fmt", ["csv", "json", "xml", "parquet"])
def test_folders_of_many_formats(spark, tmp_path, rows, fmt):
    path = tmp_path / "in"
    if fmt == "parquet":
        spark.sql("SELECT 1L AS id, DATE'2024-02-29' AS day, 'a' AS label").write.parquet(str(path))
    else:
        path.mkdir()
        (path / f"a.{fmt}").write_text(FILES[fmt])
    frame = read_folder(spark, str(path), FOLDER, fmt, row_tag="row")
    assert rows(frame) == [(1, dt.date(2024, 2, 29), "a")] and frame.columns == ["id", "day", "name"]


def test_text_and_absent_formats(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    text = Contract("t", (Column("line", "STRING"),))
    assert rows(read_folder(spark, str(tmp_path), text, "text")) == [("one",), ("two",)]
    with pytest.raises(ContractError, match="STRING"):
        read_folder(spark, str(tmp_path), FOLDER, "text")
    with pytest.raises(ContractError, match="spark-avro"):
        read_folder(spark, str(tmp_path), FOLDER, "avro")
    with pytest.raises(ContractError):
        read_folder(spark, str(tmp_path), FOLDER, "excel")


def test_relative_paths_stay_below_their_root():
    assert below_root("/landing/", "a/b") == "/landing/a/b"
    for bad in ["/a", "../a", "a/../b", "a//b", "", "."]:
        with pytest.raises(ContractError):
            below_root("/landing", bad)


def test_rows_that_differ_from_the_contract_are_refused(spark, tmp_path, data):
    f = flow(tmp_path, data, mode="APPEND_ONLY", cursor="at")
    f.run(spark)
    whole = data["frame"]
    for bad in (whole.drop("status"), whole.withColumn("more", F.lit(1)), whole.withColumn("id", F.col("id").cast("int"))):
        data["frame"] = bad
        with pytest.raises(DataRejected, match="differ from the contract"):
            f.run(spark)
    data["frame"] = whole.select("at", "status", "id").withColumn("at", F.col("at") + F.expr("interval 30 days"))
    before = Dataset(spark, f.target).read().count()
    f.run(spark)
    after = Dataset(spark, f.target).read()
    assert after.columns == whole.columns and after.count() == before + 2  # the row without a cursor value is not newer


@pytest.mark.parametrize("mode", ["SCD_TYPE_1", "SCD_TYPE_2"])
def test_a_full_refresh_has_each_key_once(spark, tmp_path, data, mode):
    f = flow(tmp_path, data, mode=mode)
    data["frame"] = data["frame"].unionByName(data["frame"].where("id = 1"))
    with pytest.raises(DataRejected, match="1 keys occur more than once"):
        f.run(spark)
    assert Dataset(spark, f.target).version() is None


def test_added_rows_keep_the_stored_columns(spark, tmp_path, data):
    target = Dataset(spark, str(tmp_path / "out"))
    target.add_to_table(data["frame"])
    with pytest.raises(DataRejected, match="other columns"):
        target.add_to_table(data["frame"].drop("status"))
    assert target.read().columns == data["frame"].columns


def test_paths_follow_the_default_filesystem(spark, tmp_path, data, rows):
    """Paths without a scheme on a session whose default filesystem is not local."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    (tmp_path / "store").mkdir()
    conf.set("fs.viewfs.mounttable.lake.link./lake", f"file://{tmp_path}/store")
    conf.set("fs.defaultFS", "viewfs://lake/")
    try:
        f = TableFlow("/lake/out", CONTRACT, lambda spark, mark: data["frame"], mode="SCD_TYPE_2")
        f.run(spark)
        data["frame"] = data["frame"].where("id < 3")
        f.run(spark)
        found = rows(Dataset(spark, "/lake/out").read("history"), "id")
    finally:
        conf.set("fs.defaultFS", before or "file:///")
    assert found == [(1,), (2,), (3,)] and sorted(p.name for p in (tmp_path / "store/out/commits").iterdir() if p.suffix == ".json") == ["000000000001.json", "000000000002.json"]


def test_object_stores_are_refused(spark):
    with pytest.raises(ContractError, match="conditional writes"):
        Dataset(spark, "s3a://bucket/table").version()


@pytest.mark.parametrize("mode, role", [("SCD_TYPE_1", "table"), ("SCD_TYPE_2", "open")])
def test_an_increment_rewrites_the_buckets_of_its_rows(spark, tmp_path, data, rows, mode, role):
    data["frame"] = spark.createDataFrame([(i, f"s{i}", at(1 + i % 3)) for i in range(200)], SCHEMA)
    f = flow(tmp_path, data, cursor="at", mode=mode, buckets=8)
    first = f.run(spark)
    live = lambda version: {p.bucket: p.path for p in version.parts if p.role == role}
    assert len(live(first)) == 8
    data["frame"] = spark.createDataFrame([(7, "new", at(9)), (7, "newer", at(10))], SCHEMA)
    second = f.run(spark)
    changed = {b for b in live(first) if live(first)[b] != live(second)[b]}
    assert len(changed) == 1 and set(live(second)) == set(live(first)) and second.info["mark"] == "2024-01-10 00:00:00"
    found = Dataset(spark, f.target).read()
    assert found.count() == 200 and rows(found.where("id = 7"), "status") == [("newer",)]
    if mode == "SCD_TYPE_2":
        closed = Dataset(spark, f.target).read("history").where(f"id = 7 and {END_AT} is not null")
        assert rows(closed, "status", START_AT, END_AT) == [("new", at(9), at(10)), ("s7", at(2), at(9))]
    assert f.run(spark).number == second.number  # nothing newer: the version stays
    data["frame"] = spark.createDataFrame([(8, "a", at(11)), (8, "b", at(11))], SCHEMA)
    with pytest.raises(Exception, match="share one key and sequence"):
        f.run(spark)
    assert Dataset(spark, f.target).version().number == second.number
    with pytest.raises(ContractError, match="number of buckets"):
        data["frame"] = spark.createDataFrame([(8, "a", at(11))], SCHEMA)
        flow(tmp_path, data, cursor="at", mode=mode, buckets=4).run(spark)


def test_the_mark_never_falls_when_other_buckets_hold_it(spark, tmp_path, data):
    f = flow(tmp_path, data, cursor="at", deleted="status = 'gone'")
    data["frame"] = spark.createDataFrame([(1, "a", at(8)), (2, "b", at(1))], SCHEMA)
    f.run(spark)
    data["frame"] = spark.createDataFrame([(2, "gone", at(9))], SCHEMA)
    assert f.run(spark).info["mark"] == "2024-01-08 00:00:00" and Dataset(spark, f.target).read().count() == 1
