import pytest

from contractflow import Column, Contract, ContractError, DataRejected, Dataset
from contractflow.plans.graph import HISTORY, Input, View, ViewGraph

COUNTS = Contract("counts", (Column("g", "BIGINT", key=True), Column("n", "BIGINT")))


def view(name, tmp_path, query="SELECT g, n FROM {0}", reads=(), inputs=None, contract=COUNTS):
    return View(name, query.format(*reads, *(inputs or {})) if isinstance(query, str) else query, contract, f"{tmp_path}/{name}", inputs or {}, reads)


@pytest.fixture
def base(spark, tmp_path):
    Dataset(spark, f"{tmp_path}/base").replace_table(spark.range(10).selectExpr("id % 3 AS g", "id AS n"))
    return {"base": Input(f"{tmp_path}/base")}


def chain(tmp_path, base):
    first = view("first", tmp_path, "SELECT g, count(*) FROM {0} GROUP BY g", inputs=base)
    doubled = view("doubled", tmp_path, lambda frames: frames["first"].selectExpr("g", "n * 2 AS n"), ("first",))
    side = view("side", tmp_path, "SELECT g, max(n) FROM {0} GROUP BY g", inputs=base)
    both = view("both", tmp_path, "SELECT a.g, a.n + b.n FROM {0} a JOIN {1} b ON a.g = b.g", ("doubled", "side"))
    return first, doubled, side, both


def test_views_are_built_after_their_inputs_and_only_when_these_moved(spark, tmp_path, base, rows):
    first, doubled, side, both = chain(tmp_path, base)
    graph = ViewGraph((both, side, doubled, first))
    built = graph.refresh(spark)
    assert sorted(built) == ["both", "doubled", "first", "side"] and built.index("first") < built.index("doubled") < built.index("both") > built.index("side")
    assert rows(Dataset(spark, both.target).read()) == [(0, 8 + 9), (1, 6 + 7), (2, 6 + 8)]
    assert graph.refresh(spark) == []
    # One input moved: what does not read it stays.
    Dataset(spark, side.target).replace_table(spark.createDataFrame([(0, 100)], "g bigint, n bigint"), {"inputs": {"base": 1}})
    assert graph.refresh(spark) == ["both"] and rows(Dataset(spark, both.target).read()) == [(0, 108)]
    Dataset(spark, f"{tmp_path}/base").replace_table(spark.range(2).selectExpr("id AS g", "id AS n"))
    assert set(graph.refresh(spark)) == {"first", "doubled", "side", "both"}
    assert rows(Dataset(spark, both.target).read()) == [(0, 2), (1, 3)]


def test_a_failing_view_stops_the_run_and_is_built_again(spark, tmp_path, base):
    first, *_ = chain(tmp_path, base)
    keyless = view("repeats", tmp_path, "SELECT 1L, n FROM {0}", ("first",))
    after = view("after", tmp_path, "SELECT g, n FROM {0}", ("repeats",))
    graph = ViewGraph((first, keyless, after))
    with pytest.raises(DataRejected, match="key-unique"):
        graph.refresh(spark)
    assert Dataset(spark, first.target).version().number == 1 and Dataset(spark, after.target).version() is None


def test_graphs_that_make_no_sense_are_refused(spark, tmp_path, base):
    first, doubled, *_ = chain(tmp_path, base)
    for views, message in [
        ((view("a", tmp_path, reads=("b",)), view("b", tmp_path, reads=("a",))), "read each other"),
        ((view("a", tmp_path, reads=("a",)),), "read each other"),
        ((doubled,), "not declared: first"),
        ((first, first), "of their own"),
        ((first, view("x", tmp_path, reads=("first",), inputs={"first": Input("/a/b")})), "one name"),
    ]:
        with pytest.raises(ContractError, match=message):
            ViewGraph(views)
    with pytest.raises(ContractError, match="hidden is not a declared input"):
        ViewGraph((view("x", tmp_path, "SELECT g, n FROM hidden", inputs=base),)).refresh(spark)
    with pytest.raises(ContractError, match="port"):
        Input("/a/b", "past")


def test_catalog_tables_have_both_ports_and_are_always_read(spark, tmp_path, rows):
    spark.createDataFrame([(1, 5, 1, None), (2, 6, 1, 2)], "g bigint, n bigint, __START_AT bigint, __END_AT bigint").write.mode("overwrite").saveAsTable("kept")
    try:
        now = view("now", tmp_path, inputs={"kept": Input("kept")})
        ever = view("ever", tmp_path, inputs={"kept": Input("kept", HISTORY)})
        graph = ViewGraph((now, ever))
        assert graph.refresh(spark) == graph.refresh(spark) == ["now", "ever"]
        assert rows(Dataset(spark, now.target).read()) == [(1, 5)] and rows(Dataset(spark, ever.target).read()) == [(1, 5), (2, 6)]
        spark.sql("SELECT 1L AS g, 2L AS n").write.mode("overwrite").saveAsTable("flat")
        with pytest.raises(ContractError, match="no history"):
            ViewGraph((view("flat", tmp_path, inputs={"flat": Input("flat", HISTORY)}),)).refresh(spark)
    finally:
        spark.sql("DROP TABLE IF EXISTS kept")
        spark.sql("DROP TABLE IF EXISTS flat")
