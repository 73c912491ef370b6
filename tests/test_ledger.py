import datetime as dt
import json

import pytest

from contractflow import DataRejected, Policy
from contractflow.operators import ledger
from contractflow.sources.ledgers import API_VERSION, dataset_ledger, read_ledger

NOW = dt.datetime(2025, 3, 5, tzinfo=dt.timezone.utc)
ROOT = "/drop/clients"
COLUMNS = (
    "dataset string, id string, version bigint, captured_at string, contract_version string, complete boolean, "
    "scope string, row_count bigint, path string"
)


def receipt(version=1, **updates):
    base = {
        "dataset": "shop.crm.clients", "id": f"load_{version}", "version": version,
        "captured_at": "2025-03-04T00:00:00Z", "contract_version": "1.0.0", "complete": True, "scope": "full-table",
        "row_count": 2, "path": f"{ROOT}/run_{version}",
    }
    return tuple({**base, **updates}.values())


def found(spark, receipts, policy=Policy(), **settings):
    frame = spark.createDataFrame(receipts, COLUMNS)
    violations = ledger.audit(frame, policy, ROOT, now=NOW, **settings).collect()
    return sorted((r.version, r.rule) for r in violations)


def test_a_good_ledger_has_no_violations(spark):
    assert found(spark, [receipt(3), receipt(1), receipt(2)]) == []


@pytest.mark.parametrize(
    "update,rule",
    [
        ({"complete": False}, "complete"),
        ({"complete": None}, "complete"),
        ({"scope": "partial"}, "complete"),
        ({"row_count": -1}, "row_count"),
        ({"row_count": 2**53}, "row_count"),
        ({"captured_at": "2025-03-04"}, "captured_at"),
        ({"captured_at": "2025-03-04T00:00:00"}, "captured_at"),
        ({"captured_at": "2026-02-30T00:00:00Z"}, "captured_at"),
        ({"contract_version": ""}, "contract_version"),
        ({"contract_version": None}, "contract_version"),
        ({"id": ""}, "id"),
        ({"id": "a b"}, "id"),
        ({"path": "/outside/run_1"}, "path"),
        ({"path": ROOT + "/../escape"}, "path"),
        ({"path": ROOT + "/run_1/extra"}, "path"),
        ({"path": ROOT}, "path"),
        ({"row_count": 0}, "empty"),
        ({"captured_at": "2026-01-01T00:00:00Z"}, "future"),
    ],
)
def test_each_rule(spark, update, rule):
    assert (1, rule) in found(spark, [receipt(1, **update)])


def test_snapshot_paths_may_be_deeper_but_not_climb(spark):
    frame = lambda path: spark.createDataFrame([receipt(0, path=path)], COLUMNS)
    rules = lambda path: [r.rule for r in ledger.receipt_violations(frame(path), ROOT).collect()]
    assert rules(ROOT + "/2026/run") == []
    for bad in [ROOT + "/a/../b", ROOT + "/./b", ROOT + "/..", "/drop/clients_2/x"]:
        assert rules(bad) == ["path"]


def test_order_rules(spark):
    assert found(spark, [receipt(1), receipt(3)]) == [(3, "gap")]
    assert found(spark, [receipt(2)]) == [(2, "gap")]
    assert found(spark, [receipt(1), receipt(2, captured_at="2025-03-03T00:00:00Z")]) == [(2, "time_order")]
    offsets = [receipt(1, captured_at="2025-03-04T01:00:00+02:00"), receipt(2, captured_at="2025-03-03T23:30:00Z")]
    assert found(spark, offsets) == []
    drop = [receipt(1, row_count=100), receipt(2, row_count=59), receipt(3, row_count=59)]
    assert found(spark, drop, Policy(maximum_drop_percent=40)) == [(2, "drop_percent")]
    assert found(spark, [receipt(1, row_count=0), receipt(2)], Policy(allow_empty=True, maximum_drop_percent=1)) == []
    assert found(spark, [receipt(1), receipt(2)], Policy(minimum_rows=3)) == [(1, "minimum_rows"), (2, "minimum_rows")]
    assert found(spark, [receipt(1)], Policy(maximum_age_hours=24)) == []
    assert found(spark, [receipt(1)], Policy(maximum_age_hours=23.9)) == [(1, "stale")]


@pytest.mark.parametrize("block_rows", [None, 1])
def test_receipts_alike_but_for_their_rows_have_one_order(spark, block_rows):
    alike = [receipt(1, row_count=20, captured_at=""), receipt(1, row_count=470, captured_at="")]
    for receipts in (alike, alike[::-1]):
        frame = spark.createDataFrame([*receipts, receipt(2, row_count=20)], COLUMNS).coalesce(1)
        broken = ledger.order_violations(frame, maximum_drop_percent=60, block_rows=block_rows).collect()
        assert [(r.version, r.rule, r.detail) for r in broken] == [(1, "drop_percent", "95.7447")]


def test_duplicates_and_datasets_are_separate(spark):
    assert found(spark, [receipt(1), receipt(1)]) == [(1, "duplicate_id"), (1, "duplicate_path"), (1, "duplicate_version")]
    assert found(spark, [receipt(1), receipt(1, dataset="retail.other.x")]) == []


def test_duplicates_shuffle_a_receipt_once_and_large_datasets_by_value(spark):
    receipts = [receipt(v, dataset=d, id=f"i{v % 3}", path=None if v == 2 else f"p{v}") for d in ("a", "b", None) for v in (1, 1, 2, 4)]
    receipts += [receipt(7, dataset="c"), receipt(7, dataset="c", path="p")]
    frame = spark.createDataFrame(receipts, COLUMNS)
    plans, results = [], []
    for block_rows in (None, 2, 1):
        duplicates = ledger.duplicate_violations(frame, block_rows)
        results.append(sorted(map(tuple, duplicates.collect()), key=repr))
        plans.append(duplicates._jdf.queryExecution().executedPlan().toString())
    expected = [(d, 1, f"duplicate_{f}", n) for d in ("a", "b", None) for f, n in (("id", "3"), ("version", "2"), ("path", "2"))]
    expected += [("c", 7, "duplicate_id", "2"), ("c", 7, "duplicate_version", "2")]
    assert results == [sorted(expected, key=repr)] * 3
    assert "field" not in "".join(line for line in plans[0].splitlines() if "Exchange" in line)


def test_capacity(spark):
    frame = spark.range(1, 10_002).selectExpr("'d' AS dataset", "id AS version")
    assert [tuple(r) for r in ledger.capacity_violations(frame).collect()] == [("d", 10001, "capacity", "10001")]


def test_pending_is_the_lowest_version_above_the_latest(spark):
    frame = spark.createDataFrame([receipt(v, dataset=d) for d in ("a", "b", "c") for v in (3, 1, 2)], COLUMNS)
    versions = lambda latest: sorted((r.dataset, r.version) for r in ledger.pending(frame, latest).collect())
    assert versions(None) == [("a", 1), ("b", 1), ("c", 1)]
    assert versions(2) == [("a", 3), ("b", 3), ("c", 3)]
    assert versions(3) == []
    latest = spark.createDataFrame([("a", 1), ("b", 3)], "dataset string, latest bigint")
    assert versions(latest) == [("a", 2), ("c", 1)]
    assert ledger.contract_violations(ledger.pending(frame), "2.0.0").count() == 3


def test_policies_merge_and_are_checked():
    merged = Policy(minimum_rows=5).over(Policy(minimum_rows=1, allow_empty=True))
    assert (merged.minimum_rows, merged.allow_empty) == (5, True)
    for bad in ({"maximum_drop_percent": 101}, {"maximum_age_hours": 0}, {"minimum_rows": -1}, {"maximum_drop_percent": True}):
        with pytest.raises(ValueError):
            Policy(**bad)


def index(dataset="shop.crm.clients", **updates):
    delivery = {
        "id": "snapshot-1", "version": 1, "capturedAt": "2025-02-01T00:00:00Z", "contractVersion": "1.0.0",
        "complete": True, "scope": "full-table", "rowCount": 2, "path": ROOT + "/snapshot-1",
    }
    return {"apiVersion": API_VERSION, "dataset": dataset, "deliveries": [delivery, {**delivery, "version": 2}], **updates}


def test_indexes_of_many_datasets_are_read_in_one_job(spark, tmp_path):
    for name in ("a.b.c", "a.b.d"):
        (tmp_path / f"{name}.json").write_text(json.dumps(index(name), indent=1))
    assert read_ledger(spark, str(tmp_path)).groupBy("dataset").count().count() == 2
    (tmp_path / "broken.json").write_text("{")
    broken = read_ledger(spark, str(tmp_path)).where("dataset IS NULL")
    assert {r.rule for r in ledger.receipt_violations(broken).collect()} >= {"id", "version", "complete"}


def test_wrongly_typed_receipt_values_are_reported(spark, tmp_path):
    bad = index()
    bad["deliveries"] = [{**bad["deliveries"][0], "version": True, "rowCount": "2", "complete": "true"}]
    (tmp_path / "i.json").write_text(json.dumps(bad))
    rules = {r.rule for r in ledger.receipt_violations(read_ledger(spark, str(tmp_path / "i.json"))).collect()}
    assert {"version", "row_count", "complete"} <= rules


def test_one_dataset_has_one_index_of_its_own(spark, tmp_path):
    path = tmp_path / "i.json"
    path.write_text(json.dumps(index()))
    assert dataset_ledger(spark, str(path), "shop.crm.clients").count() == 2
    with pytest.raises(DataRejected):
        dataset_ledger(spark, str(path), "shop.crm.others")
    path.write_text(json.dumps(index(apiVersion="other/v1")))
    with pytest.raises(DataRejected):
        dataset_ledger(spark, str(path), "shop.crm.clients")
    (tmp_path / "j.json").write_text(json.dumps(index()))
    with pytest.raises(DataRejected, match="exactly one"):
        dataset_ledger(spark, str(tmp_path), "shop.crm.clients")
