import datetime as dt
import json

import pytest

from contractflow import Column, Contract, ContractError, DataRejected, Dataset, Policy, QualityFailed, SnapshotFlow, SourceTerms, publish
from contractflow.contract import END_AT, START_AT
from contractflow.operators import history
from contractflow.plans.publication import latest_index
from contractflow.plans.snapshots import from_published
from contractflow.sources.ledgers import API_VERSION

NOW = dt.datetime(2025, 3, 5, tzinfo=dt.timezone.utc)
DATASET = "shop.crm.clients"
CONTRACT = Contract(
    "customers",
    (
        Column("id", "BIGINT", required=True, key=True),
        Column("left", "STRING", target="right"),
        Column("right", "STRING", target="left"),
        Column("day", "DATE"),
    ),
    "1.0.0",
)
SCHEMA = "id bigint, left string, right string, day date"
DAY = dt.date(2024, 2, 29)


class Source:
    """A folder of snapshots and its delivery index."""

    def __init__(self, spark, root):
        self.spark, self.root, self.deliveries = spark, str(root), []

    def add(self, version, rows, fmt="parquet", schema=SCHEMA, **updates):
        path = f"{self.root}/run_{version}"
        self.spark.createDataFrame(rows, schema).write.format(fmt).save(path)
        self.deliveries.append(
            {
                "id": f"d{version}", "version": version, "capturedAt": "2025-03-04T00:00:00Z", "contractVersion": "1.0.0",
                "complete": True, "scope": "full-table", "rowCount": len(rows), "path": path, **updates,
            }
        )
        self.write()

    def write(self):
        body = {"apiVersion": API_VERSION, "dataset": DATASET, "deliveries": self.deliveries}
        with open(f"{self.root}/index.json", "w") as file:
            json.dump(body, file, indent=1)


@pytest.fixture
def source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    return Source(spark, tmp_path / "in")


def flow(source, **settings):
    return SnapshotFlow(
        **{
            "dataset": DATASET, "contract": CONTRACT, "source_root": source.root, "index": source.root + "/index.json",
            "target": source.root + "/../out", **settings,
        }
    )


def target(spark, flow):
    return Dataset(spark, flow.target)


def test_deliveries_apply_in_version_order(spark, source, rows):
    source.add(9, [(1, "a", "b", DAY), (3, "n", "n", DAY)])
    source.add(4, [(1, "a", "b", DAY), (2, "x", "y", None)])
    f = flow(source)
    assert f.apply_next(spark, NOW).info["delivery"] == 4
    assert f.apply_next(spark, NOW).info["delivery"] == 9
    assert f.apply_next(spark, NOW) is None
    got = target(spark, f).read("history")
    assert rows(got, "id", "right", "left", START_AT, END_AT) == [(1, "a", "b", 4, None), (2, "x", "y", 4, 9), (3, "n", "n", 9, None)]
    current = target(spark, f).read()
    assert current.columns == ["id", "right", "left", "day"] and current.count() == 2
    source.add(12, [(2, "back", "y", None), (1, "a", "CHANGED", DAY)])
    assert f.catch_up(spark, NOW) == 1
    rebuilt = f.rebuild(spark, source.root + "/../rebuilt", deliveries_per_step=2)
    assert history.reconcile(target(spark, f).read("history"), rebuilt.read("history")).count() == 0
    assert rebuilt.version().number == 2
    with pytest.raises(ContractError, match="empty location"):
        f.rebuild(spark, source.root + "/../rebuilt")
    pinned, number = target(spark, f).read_pinned("history", 1)
    assert (pinned.count(), number) == (2, 1)
    before = rows(target(spark, f).read("history"))
    target(spark, f).compact_history()
    assert rows(target(spark, f).read("history")) == before


def test_closed_folders_are_merged_by_level(spark, source, rows, monkeypatch):
    monkeypatch.setattr("contractflow.sources.datasets.MERGE_AT", 2)
    f = flow(source)
    for version in range(1, 8):
        source.add(version, [(1, f"v{version}", "b", DAY)])
    assert f.catch_up(spark, NOW) == 7
    got = rows(target(spark, f).read("history"), "right", START_AT, END_AT)
    assert got == [(f"v{v}", v, v + 1 if v < 7 else None) for v in range(1, 8)]
    closed = [p for p in target(spark, f).version().parts if p.role == "closed"]
    assert max(p.level or 0 for p in closed) == 2 and len(closed) < 6


def test_tracked_columns_update_in_place(spark, source, rows):
    source.add(1, [(1, "a", "b", DAY)])
    source.add(2, [(1, "a", "c", DAY)])
    f = flow(source, tracked=["left"])
    f.catch_up(spark, NOW)
    assert rows(target(spark, f).read("history"), "left", START_AT, END_AT) == [("c", 1, None)]


@pytest.mark.parametrize(
    "updates,message",
    [
        ({"complete": False}, "complete"),
        ({"rowCount": 3}, "row count"),
        ({"path": "/outside/data"}, "path"),
        ({"contractVersion": "9.0"}, "contract_mismatch"),
        ({"capturedAt": "invalid"}, "captured_at"),
        ({"capturedAt": "2026-01-01T00:00:00Z"}, "future"),
    ],
)
def test_bad_deliveries_apply_nothing(spark, source, updates, message):
    source.add(1, [(1, "a", "b", DAY)], **updates)
    f = flow(source)
    with pytest.raises(DataRejected, match=message):
        f.apply_next(spark, NOW)
    assert target(spark, f).version() is None


def test_processed_deliveries_may_have_an_older_contract(spark, source):
    source.add(1, [(1, "a", "b", DAY)])
    f = flow(source)
    f.apply_next(spark, NOW)
    source.deliveries[0]["contractVersion"] = "0.9.0"
    source.add(2, [(1, "a", "b", DAY)])
    assert f.apply_next(spark, NOW).info["delivery"] == 2


def test_policies(spark, source):
    source.add(1, [(i, "a", "b", DAY) for i in range(10)])
    f = flow(source, policy=Policy(maximum_drop_percent=25, maximum_age_hours=48))
    f.apply_next(spark, NOW)
    source.add(2, [(1, "a", "b", DAY)])
    with pytest.raises(DataRejected, match="disappeared"):
        f.apply_next(spark, NOW)
    first = source.deliveries.pop(0)
    source.write()
    with pytest.raises(DataRejected, match="previous delivery"):
        f.apply_next(spark, NOW)
    source.deliveries = [first]
    source.write()
    assert f.apply_next(spark, NOW) is None
    with pytest.raises(DataRejected, match="stale"):
        f.apply_next(spark, NOW + dt.timedelta(days=3))
    source.add(3, [])
    with pytest.raises(DataRejected, match="empty"):
        flow(source).apply_next(spark, NOW)
    with pytest.raises(DataRejected, match="minimum_rows"):
        flow(source, policy=Policy(allow_empty=True, minimum_rows=1)).apply_next(spark, NOW)
    assert flow(source, policy=Policy(allow_empty=True)).apply_next(spark, NOW).info["delivery"] == 3
    assert target(spark, f).read().count() == 0


@pytest.mark.parametrize(
    "rows,message",
    [
        ([(None, "a", "b", DAY)], "required.id"),
        ([(1, "a", "b", DAY), (1, "c", "d", DAY)], "more than once"),
        ([(1, "too long", "b", DAY)], "business.short"),
    ],
)
def test_bad_rows_are_never_dropped(spark, source, rows, message):
    source.add(1, rows)
    f = flow(source, expectations={"short": "length(right) < 5"})
    with pytest.raises(DataRejected, match=message):
        f.apply_next(spark, NOW)


def test_quality_is_judged_before_load(spark, source):
    rule = {"id": "known", "metric": "invalidValues", "arguments": {"validValues": ["a"]}, "mustBe": 0, "severity": "error"}
    judged = Contract("customers", (Column("id", "BIGINT", key=True), Column("name", "STRING", quality=(rule,))), "1.0.0")
    source.add(1, [(1, "secret-value")], schema="id bigint, name string")
    f = flow(source, contract=judged, results=source.root + "/../results")
    with pytest.raises(QualityFailed, match="not applied: known") as error:
        f.apply_next(spark, NOW)
    assert "secret-value" not in str(error.value)
    kept = Dataset(spark, f.results).read().first()
    assert (kept.id, kept.value, kept.passed, kept.enforcement) == ("known", "1", False, "before-load")
    assert kept.context == {"dataset": DATASET, "delivery": "1"}


def test_freshness_of_a_flow(spark, source):
    source.add(1, [(1, "a", "b", DAY)])
    f = flow(source, freshness=("day", 24))
    f.apply_next(spark, NOW)
    f.check_fresh(spark, dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc))
    with pytest.raises(DataRejected, match="too old"):
        f.check_fresh(spark, NOW)


def test_source_terms():
    good = SourceTerms("complete-snapshot", "missing-keys", "full-table", None, "externally-retained", "P90D")
    assert good.recovery("snapshot")["replay"] == "external-deliveries"
    assert SourceTerms("immutable-files", "not-applicable").recovery("append")["replay"] == "unavailable"
    SourceTerms("change-events", "explicit-events", baseline="included").check("events")
    for bad, standard in [
        (SourceTerms("change-events", "explicit-events"), "events"),
        (SourceTerms("complete-snapshot", "missing-keys"), "snapshot"),
        (SourceTerms("complete-snapshot", "explicit-events", "full-table"), "snapshot"),
        (SourceTerms("immutable-files", "not-applicable", baseline="included"), "append"),
        (SourceTerms("immutable-files", "not-applicable", None, None, "externally-retained"), "append"),
        (SourceTerms("immutable-files", "not-applicable", None, None, "not-retained", "P90D"), "append"),
        (SourceTerms("immutable-files", "not-applicable", None, None, "externally-retained", "90 days"), "append"),
    ]:
        with pytest.raises(ContractError):
            bad.check(standard)


def test_json_snapshots_parse_strictly(spark, source, rows):
    text = "id bigint, left string, right string, day string"
    source.add(1, [(1, "a", "b", "2024-02-29")], fmt="json", schema=text)
    f = flow(source, fmt="json")
    f.apply_next(spark, NOW)
    assert rows(target(spark, f).read(), "day") == [(DAY,)]
    source.add(2, [(1, "a", "b", "2023-02-29")], fmt="json", schema=text)
    with pytest.raises(DataRejected, match="temporal"):
        f.apply_next(spark, NOW)
    source.deliveries.pop()
    source.add(3, [("secret-value", "a", "b", None)], fmt="json", schema="id string, left string, right string, day string")
    with pytest.raises(DataRejected) as error:
        f.apply_next(spark, NOW)
    assert "secret-value" not in str(error.value)


def test_malformed_values_that_no_check_reads_are_refused_too(spark, source):
    counted = Contract("customers", (Column("id", "BIGINT", key=True), Column("n", "BIGINT")), "1.0.0")
    source.add(1, [(1, "secret-value")], fmt="json", schema="id bigint, n string")
    f = flow(source, contract=counted, fmt="json")
    with pytest.raises(DataRejected) as error:
        f.apply_next(spark, NOW)
    assert "secret-value" not in str(error.value) and target(spark, f).version() is None


def test_parquet_types_are_checked_first(spark, source):
    source.add(1, [(1, "a", "b", dt.datetime(2024, 1, 1))], schema="id bigint, left string, right string, day timestamp")
    with pytest.raises(DataRejected, match="time zone"):
        flow(source).apply_next(spark, NOW)


def test_settings_are_checked_when_a_flow_is_defined(source):
    for settings in [
        {"index": "/elsewhere/index.json"},
        {"terms": SourceTerms("change-events", "missing-keys", "full-table")},
        {"freshness": ("id", 5)},
        {"fmt": "csv"},
        {"reader": {"mode": "DROPMALFORMED"}},
        {"tracked": ["unknown"]},
        {"keys": []},
        {"contract": Contract("t", (Column("id", "BIGINT", key=True),))},
    ]:
        with pytest.raises(ContractError):
            flow(source, **settings)


def test_a_published_snapshot_feeds_another_flow(spark, source, rows):
    source.add(1, [(1, "a", "b", DAY)], schema="id bigint, right string, left string, day date")
    upstream = CONTRACT.published()
    publish(spark, source.root + "/_index", source.deliveries[0], DATASET, source.root, CONTRACT, initialise=True, now=NOW)
    index = source.root + "/_index"
    assert latest_index(spark, index).startswith(index)
    f = from_published(upstream, upstream, DATASET, index, source.root, target=source.root + "/../out")
    assert f.catch_up(spark, NOW) == 1
    source.add(2, [(2, "a", "b", DAY)], schema="id bigint, right string, left string, day date")
    publish(spark, index, source.deliveries[1], DATASET, source.root, CONTRACT, now=NOW)
    assert f.catch_up(spark, NOW) == 1
    other = Contract("customers", upstream.columns, "2.0.0")
    with pytest.raises(ContractError):
        from_published(other, upstream, DATASET, index, source.root, target="out")


def test_a_second_writer_loses_the_commit(spark, source):
    source.add(1, [(1, "a", "b", DAY)])
    f = flow(source)
    f.apply_next(spark, NOW)
    store = target(spark, f)
    stale = store.version()
    store.compact_history()
    with pytest.raises(Exception, match="another writer"):
        store.commit(stale, stale.schema, stale.parts, {})


def test_a_rebuild_passes_every_check_again(spark, source, tmp_path):
    """Deliveries that are waiting stay out, and one that could not be applied today cannot be rebuilt."""
    f = flow(source)
    source.add(1, [(1, "a", "b", DAY)])
    source.add(2, [(1, "c", "b", DAY), (2, "d", "b", DAY)])
    f.catch_up(spark, NOW)
    source.add(3, [(2, "waits", "b", DAY)])
    rebuilt = f.rebuild(spark, str(tmp_path / "one"))
    assert rebuilt.version().info == {"delivery": 2}
    assert history.reconcile(target(spark, f).read("history"), rebuilt.read("history")).count() == 0
    good = [dict(d) for d in source.deliveries]
    for n, change in enumerate([{"rowCount": 3}, {"contractVersion": "0.9.0"}, {"path": "/elsewhere/run_2"}, {"id": "d1"}]):
        source.deliveries = [good[0], {**good[1], **change}, good[2]]
        source.write()
        with pytest.raises(DataRejected):
            f.rebuild(spark, str(tmp_path / f"bad{n}"))
    spark.createDataFrame([(1, "c", "b", DAY), (1, "d", "b", DAY)], SCHEMA).write.mode("overwrite").parquet(good[1]["path"])
    source.deliveries = good
    source.write()
    with pytest.raises(DataRejected, match="more than once"):
        f.rebuild(spark, str(tmp_path / "doubled"))
