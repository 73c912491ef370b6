"""Every registered query against the same result in SQL, and the shape of the important plans."""

import io
import contextlib
import re

import pytest

from __spark_entry__ import entry
from suite import inputs
from suite.compare import connect, duck_rows, spark_rows
from suite.flows import FLOWS
from suite.oracle import SQL
from suite.spark_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ALL = {**QUERIES, **FLOWS}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(ALL) == set(SQL)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(ALL[name](spark, FOLDER)) == duck_rows(con, SQL[name])


def test_entry(spark):
    assert entry(spark).columns[-2:] == ["__START_AT", "__END_AT"] and entry(spark).count() > 0


def plan(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def operators(frame, name):
    return len(re.findall(rf"^\(\d+\) {name}", plan(frame), re.M))


@pytest.mark.parametrize("name", ["scd2_snapshots", "scd2_snapshots_tracked", "scd2_events", "scd2_events_tracked"])
def test_histories_shuffle_and_sort_once(spark, name):
    frame = ALL[name](spark, FOLDER)
    assert (operators(frame, "Exchange"), operators(frame, "Sort")) == (1, 1)


def test_history_of_events_reads_only_its_columns(spark):
    text = plan(ALL["scd2_events_tracked"](spark, FOLDER))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text


@pytest.mark.parametrize("name", ["dq_null_values", "dq_operators", "required_violations", "business_expectation", "dq_event_waiver"])
def test_row_rules_share_one_scan_and_shuffle_one_row_per_task(spark, name):
    frame = ALL[name](spark, FOLDER)
    text = plan(frame)
    assert operators(frame, "Scan") == 1 and "hashpartitioning" not in text and text.count("SinglePartition") == 1


def test_cursor_filter_reaches_the_scan(spark):
    from contractflow.operators.history import after_cursor

    rows = after_cursor(inputs.table(spark, FOLDER, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1998-01-01")
    text = plan(rows)
    assert "PushedFilters: [IsNotNull(o_orderdate)" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in text


def test_no_query_uses_python_workers_or_cross_joins(spark):
    for name, run in ALL.items():
        text = plan(run(spark, FOLDER))
        assert not re.search(r"Python|Pandas|Cartesian|BroadcastNestedLoop", text), name
