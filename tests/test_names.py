"""No column of the data may be lost to, or clash with, a column that the engine adds for its own use."""

import functools
import json

import pytest
from pyspark.sql import functions as F

from contractflow import AppendFlow, ChangeFlow, Column, Contract, ContractError, Dataset, TableFlow
from contractflow.contract import END_AT, HELPER, START_AT
from contractflow.operators import blocks, history, quality, verify
from contractflow.functions.rules import MANAGED, compile_rules

#: Names that partition columns, reports or helpers have or once had.
NAMES = (
    "ROLE", "batch", "role", "bucket", "start", "end", "row", "rows", "n", "missing", "events", "change", "copies", "surplus", "value", "key", "keys",
    "_live", "_seq", "_until", "_group", "_p0", "_p1", "_starts", "_open", "_after", "_old", "_new", "_n", "_rows", "_block", "_place", "_version",
    "_next", "_top", "_gone", "_row", "_at", "_cut", "_anchor", "_start", "_last", "_first", "_low", "_high", "_previous", "_any", "_v", "_r", "c0",
    "_source_file", "_corrupt_record", "_temporal_invalid", "version", "sequence", "first", "none",
)


DISTINCT = [n for i, n in enumerate(NAMES) if n.lower() not in {m.lower() for m in NAMES[:i]}]


@pytest.mark.parametrize("as_keys", [False, True])
def test_operators_take_any_name(spark, rows, as_keys):
    """All names at once, as columns of values or as one composite key."""
    names = ["id", *DISTINCT, "seq", "text"]
    keys = ["id", *DISTINCT] if as_keys else ["id"]
    row = lambda i, text, seq: (i, *[f"{n}" for n in DISTINCT], seq, text)
    schema = ", ".join(f"`{n}` {'int' if n in ('id', 'seq') else 'string'}" for n in names)
    old = spark.createDataFrame([row(1, "a", 1), row(2, "b", 1), row(3, "c", 1)], schema)
    new = spark.createDataFrame([row(1, "a", 2), row(2, "x", 2), row(4, "d", 2)], schema)
    both = old.union(new)
    whole = [F.concat_ws(",", *[f"`{n}`" for n in DISTINCT]) == ",".join(DISTINCT)]

    def kept(frame, *columns):
        assert frame.where(~functools.reduce(lambda a, b: a & b, whole)).isEmpty() and not [c for c in frame.columns if c.startswith(HELPER)]
        return rows(frame, "id", "text", *columns)

    wanted = [(1, "a", 1, None), (2, "b", 1, 2), (2, "x", 2, None), (3, "c", 1, None), (4, "d", 2, None)]
    assert kept(history.scd2_from_events(both, keys, "seq"), START_AT, END_AT) == wanted
    assert kept(history.scd2_from_events(both, keys, "seq", block_rows=1), START_AT, END_AT) == wanted
    first, second = old.drop("seq"), new.drop("seq")
    opened = history.apply_snapshot(None, first, keys, 1)
    stepped = history.scd2_from_snapshots(opened, second, keys, 2)
    assert kept(stepped) == [(1, "a"), (2, "b"), (2, "x"), (3, "c"), (4, "d")]
    assert kept(history.scd2_from_snapshot_series([(1, first), (2, second)], keys)) == kept(stepped)
    assert [(r[0], r[-1]) for r in rows(history.snapshot_diff(first, second, keys))] == [(2, "update"), (3, "delete"), (4, "insert")]
    assert kept(history.latest_rows(both, keys, "seq")) == [(1, "a"), (2, "x"), (3, "c"), (4, "d")]
    assert kept(history.scd1_merge(old, new, keys, "seq", "text = 'd'")) == [(1, "a"), (2, "x"), (3, "c")]
    assert history.sequence_conflicts(old.union(old.replace("a", "z", "text")), keys, "seq").count() == 1
    assert sorted(r[-1] for r in history.reconcile(first, second).collect()) == [-1, -1, 1, 1]
    assert [(r[0], r[-1]) for r in rows(verify.duplicate_keys(both, keys))] == [(1, 2), (2, 2)]
    contract = Contract("t", tuple(Column(n, "INT" if n in ("id", "seq") else "STRING", key=n in keys) for n in names))
    verify.verify_snapshot(old, contract, 3)
    assert all(r.passed for r in quality.evaluate(old, compile_rules(contract, MANAGED, "error")).collect())
    assert kept(blocks.with_previous(both, keys, ["seq"], DISTINCT).drop(f"{HELPER}previous")) == kept(both)


@pytest.mark.parametrize("keys", [("role",), ("batch", "bucket")])
def test_sinks_keep_any_column(spark, rows, tmp_path, keys):
    names = [n for n in DISTINCT if n not in ("version", "sequence")]
    contract = Contract("t", (*[Column(n, "STRING", key=n.lower() in keys) for n in names], Column("text", "STRING"), Column("seq", "BIGINT"), Column("op", "STRING")))
    record = lambda i, text, seq, op: {**{n: f"{i}" if n.lower() in keys else n for n in names}, "text": text, "seq": seq, "op": op}
    (tmp_path / "in").mkdir()
    records = [record(1, "a", 1, "I"), record(1, "b", 2, "U"), record(2, "c", 3, "I")]
    (tmp_path / "in" / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    source = str(tmp_path / "in")
    feed = ChangeFlow(contract, source, str(tmp_path / "feed"), str(tmp_path / "s1"), sequence="seq", operation_column="op", buckets=2)
    append = AppendFlow(contract, source, str(tmp_path / "append"), str(tmp_path / "s2"))
    frame = spark.createDataFrame([tuple(r.values()) for r in (records[1], records[2])], contract.schema())
    tables = [TableFlow(str(tmp_path / mode), contract, lambda s, mark: frame, mode=mode, cursor=cursor) for mode, cursor in (("SCD_TYPE_2", None), ("SCD_TYPE_1", "seq"), ("APPEND_ONLY", "seq"))]
    for flow in (feed, append, *tables):
        flow.run(spark)
    feed.compact(spark)

    def kept(frame, *columns):
        others = [n for n in names if n.lower() not in keys]
        assert frame.where(F.concat_ws(",", *[f"`{n}`" for n in others]) != ",".join(others)).isEmpty()
        return rows(frame, keys[0], "text", *columns)

    assert kept(Dataset(spark, feed.target).read("history"), START_AT, END_AT) == [("1", "a", 1, 2), ("1", "b", 2, None), ("2", "c", 3, None)]
    assert kept(feed.staged_events(spark)) == kept(Dataset(spark, append.target).read()) == [("1", "a"), ("1", "b"), ("2", "c")]
    for flow in tables:
        assert kept(Dataset(spark, flow.target).read()) == [("1", "b"), ("2", "c")]


def test_the_engines_own_names_are_reserved():
    for name in (f"{HELPER}role", f"{HELPER}x".upper()):
        with pytest.raises(ContractError, match="reserved"):
            Contract("t", (Column(name, "INT"),))
        with pytest.raises(ContractError, match="reserved"):
            Contract("t", (Column("a", "INT", target=name),))
