import datetime as dt
import random

import brute
import pytest
from pyspark.sql import functions as F

from contractflow.contract import END_AT, START_AT
from contractflow.errors import ContractError
from contractflow.operators import history
from contractflow.operators.blocks import BLOCK, PREVIOUS, split_hot, with_previous

SCHEMA = "k bigint, seq bigint, op string, a string, b bigint"


def random_events(seed, keys=6, events=400, hot=0):
    """Events with unique sequences; ``hot`` of them belong to key 0."""
    rng = random.Random(seed)
    out = []
    for seq in rng.sample(range(10 * events), events):
        key = 0 if len(out) < hot else rng.randrange(keys)
        out.append((key, seq, rng.choice("IUUUD"), rng.choice(["x", "y", None]), rng.randrange(3)))
    rng.shuffle(out)
    return out


def expected(events, tracked=("a", "b")):
    return brute.scd2([(k, s, op, {"a": a, "b": b}) for k, s, op, a, b in events], tracked)


def found(frame):
    return sorted(
        ((r.k, tuple(sorted({"a": r.a, "b": r.b}.items())), r[START_AT], r[END_AT]) for r in frame.collect()), key=repr
    )


@pytest.mark.parametrize("tracked", [None, ["a"], ["b"]])
@pytest.mark.parametrize("block_rows", [None, 100, 7])
def test_events_match_brute_force(spark, tracked, block_rows):
    events = random_events(1, hot=200)
    frame = spark.createDataFrame(events, SCHEMA)
    result = history.scd2_from_events(frame, ["k"], "seq", operation="op", tracked=tracked, block_rows=block_rows)
    assert result.columns == ["k", "a", "b", START_AT, END_AT]
    assert found(result) == expected(events, tracked or ("a", "b"))


def test_one_long_unchanged_run_across_blocks(spark):
    events = [(1, s, "U", "same", s % 5) for s in range(100)] + [(2, 5, "U", "z", 1)]
    result = history.scd2_from_events(
        spark.createDataFrame(events, SCHEMA), ["k"], "seq", operation="op", tracked=["a"], block_rows=6
    )
    assert found(result) == expected(events, ("a",))


def test_equal_states_separated_inside_a_block_do_not_merge(spark):
    events = [(1, s, "U", "x" if s in (0, 9, 10, 19) else "y", 0) for s in range(20)]
    result = history.scd2_from_events(spark.createDataFrame(events, SCHEMA), ["k"], "seq", operation="op", block_rows=10)
    assert found(result) == expected(events)


def test_delete_before_its_insert_wins_by_sequence(spark):
    frame = spark.createDataFrame([(1, 9, "D", None, None), (1, 3, "I", "x", 1)], SCHEMA)
    assert found(history.scd2_from_events(frame, ["k"], "seq", operation="op")) == [
        (1, (("a", "x"), ("b", 1)), 3, 9)
    ]
    unknown = spark.createDataFrame([(1, 9, "D", None, None)], SCHEMA)
    assert history.scd2_from_events(unknown, ["k"], "seq", operation="op").count() == 0


def test_exact_duplicates_collapse_and_conflicts_fail(spark):
    same = [(1, 3, "U", "x", 1)] * 3
    assert found(history.scd2_from_events(spark.createDataFrame(same, SCHEMA), ["k"], "seq", operation="op")) == [
        (1, (("a", "x"), ("b", 1)), 3, None)
    ]
    for other in [(1, 3, "U", "y", 1), (1, 3, "D", "x", 1), (1, 3, "U", "x", None)]:
        frame = spark.createDataFrame([*same, other], SCHEMA)
        with pytest.raises(Exception, match="one key and sequence"):
            history.scd2_from_events(frame, ["k"], "seq", operation="op", tracked=["a"]).collect()
        assert history.sequence_conflicts(frame, ["k"], "seq").collect() == [(1, 3, 4)]


def test_tracked_columns_must_be_published(spark):
    frame = spark.createDataFrame([(1, 3, "U", "x", 1)], SCHEMA)
    with pytest.raises(ContractError):
        history.scd2_from_events(frame, ["k"], "seq", operation="op", tracked=["op"])


def random_snapshots(seed, versions=5, keys=30):
    rng = random.Random(seed)
    state = {}
    out = {}
    for v in sorted(rng.sample(range(1, 50), versions)):
        for k in range(keys):
            roll = rng.random()
            if roll < 0.3:
                state.pop(k, None)
            elif roll < 0.7:
                state[k] = {"a": rng.choice(["x", "y", None]), "b": rng.randrange(2)}
        out[v] = dict(state)
    return out


@pytest.mark.parametrize("tracked", [None, ["a"], []])
def test_snapshots_one_by_one_in_bulk_and_brute_force_agree(spark, tracked):
    snapshots = random_snapshots(3)
    frames = [
        (v, spark.createDataFrame([(k, p["a"], p["b"]) for k, p in rows.items()], "k bigint, a string, b bigint"))
        for v, rows in snapshots.items()
    ]
    stepwise = None
    for version, frame in frames:
        stepwise = history.scd2_from_snapshots(stepwise, frame, ["k"], version, tracked)
    bulk = history.scd2_from_snapshot_series(list(reversed(frames)), ["k"], tracked)
    wanted = brute.from_snapshots(snapshots, ("a", "b") if tracked is None else tracked)
    assert found(stepwise) == wanted
    assert found(bulk) == wanted
    assert history.reconcile(stepwise, bulk).count() == 0
    begun = history.scd2_from_snapshot_series(frames[:2], ["k"], tracked)
    opened, closed = (begun.where(F.col(END_AT).isNull() == flag) for flag in (True, False))
    continued = closed.unionByName(history.scd2_from_snapshot_series(frames[2:], ["k"], tracked, opened))
    assert found(continued) == wanted


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k bigint, a string")
    new = spark.createDataFrame([(1, "x"), (2, None), (4, "z")], "k bigint, a string")
    assert sorted(tuple(r) for r in history.snapshot_diff(old, new, ["k"]).collect()) == [
        (2, "update"), (3, "delete"), (4, "insert")
    ]


def test_scd1_keeps_newer_rows_and_removes_only_flagged_ones(spark):
    schema = "k bigint, at bigint, a string"
    stored = spark.createDataFrame([(1, 5, "old"), (2, 9, "newer"), (3, 1, "stays"), (4, 2, "gone")], schema)
    updates = spark.createDataFrame([(1, 7, "new"), (2, 8, "late"), (4, 3, "x"), (5, 1, "first"), (5, 2, "second")], schema)
    merged = history.scd1_merge(stored, updates, ["k"], "at", deleted="a = 'x'")
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 7, "new"), (2, 9, "newer"), (3, 1, "stays"), (5, 2, "second")]


def test_equal_cursor_prefers_the_update(spark):
    schema = "k bigint, at bigint, a string"
    merged = history.scd1_merge(
        spark.createDataFrame([(1, 5, "z")], schema), spark.createDataFrame([(1, 5, "a")], schema), ["k"], "at"
    )
    assert [tuple(r) for r in merged.collect()] == [(1, 5, "a")]


def test_cursor_skips_rows_without_a_value(spark):
    frame = spark.createDataFrame([(1, 5), (2, None), (3, 6)], "k bigint, at bigint")
    assert [r.k for r in history.after_cursor(frame, "at", 5).collect()] == [3]
    assert [r.k for r in history.after_cursor(frame, "at").collect()] == [1, 3]
    assert history.high_water_mark(frame, "at").first()[0] == 6


def test_cursor_marks_ignore_the_session_zone(spark):
    frame = spark.sql("SELECT 1L AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS at UNION ALL SELECT 2L, TIMESTAMP_NTZ'2024-01-01 00:00:01'")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert [r.k for r in history.after_cursor(frame, "at", dt.datetime(2024, 1, 1)).collect()] == [2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reconcile_counts_copies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    right = spark.createDataFrame([(1,), (3,)], "k bigint")
    assert sorted(tuple(r) for r in history.reconcile(left, right).collect()) == [(1, 1), (2, 1), (3, -1)]


def test_struct_sequence_orders_by_both_columns(spark):
    day = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(1, day, 2, "U", "b"), (1, day, 1, "U", "a"), (1, day + dt.timedelta(1), 0, "D", None)],
        "k bigint, ts timestamp_ntz, id bigint, op string, a string",
    )
    result = history.scd2_from_events(frame, ["k"], ["ts", "id"], operation="op")
    assert [(r.a, r[START_AT].id, r[END_AT].id) for r in result.orderBy("a").collect()] == [("a", 1, 2), ("b", 2, 0)]


def test_a_hot_key_is_split_into_blocks(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    split = split_hot(frame, ["k"], ["id"], 100)
    sizes = [r["count"] for r in split.hot.groupBy(BLOCK).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 400 and len(sizes) >= 5
    assert split.cold.count() == 2000
    assert split_hot(frame, ["k"], ["id"], 1000).hot is None


def test_previous_rows_across_blocks(spark):
    frame = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    for limit in (None, 20):
        result = with_previous(frame, ["k"], ["v"], ["v"], limit)
        assert {r.v: r[PREVIOUS] and r[PREVIOUS].v for r in result.collect()} == {
            v: v - 2 if v > 1 else None for v in range(500)
        }


def random_table(spark, rng, keys, version):
    rows = [(k, rng.choice([None, "a", "b"]), rng.choice([None, 0.0, 1.5, float("nan")]), rng.choice([None, "a", "b"])) for k in keys]
    return spark.createDataFrame(rows, "k int, a string, x double, b string")


@pytest.mark.parametrize("tracked", [None, ["a"]])
def test_fingerprints_first_gives_the_same_history(spark, rows, tracked):
    rng = random.Random(3)
    snapshots = [(v, random_table(spark, rng, rng.sample(range(40), rng.choice([0, 20, 35])), v)) for v in range(1, 5)]
    plain = quick = None
    for version, snapshot in [*snapshots, (9, snapshots[-1][1])]:
        plain = history.apply_snapshot(plain and plain.where(f"{END_AT} is null"), snapshot, ["k"], version, tracked)
        quick = history.advance_snapshot(quick and quick.where(f"{END_AT} is null"), snapshot, ["k"], version, tracked)
        assert list(map(repr, rows(quick))) == list(map(repr, rows(plain)))


def test_an_unchanged_snapshot_shuffles_keys_and_fingerprints(spark):
    opened = history.apply_snapshot(None, spark.range(1000).selectExpr("id AS k", "repeat('x', 50) AS body"), ["k"], 1)
    frame = history.advance_snapshot(opened, opened.select("k", "body"), ["k"], 2)
    assert frame.count() == 1000
    changed = history.changed_keys(opened, opened.select("k", "body"), ["k"], ["body"])
    exchanged = [line for line in changed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Project" in line]
    assert any("__cf_old0" in line and "body" not in line.split("xxhash64")[0] for line in exchanged)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("BroadcastHashJoin")[-1] and plan.count("LeftAnti, BuildRight") >= 1


def test_reconcile_compares_digests_first(spark, rows):
    rng = random.Random(5)
    data = [(rng.randrange(50), rng.choice([None, "a", "b"]), rng.choice(["a", None])) for _ in range(400)]
    left = spark.createDataFrame(data, "k int, a string, b string")
    right = spark.createDataFrame(rng.sample(data, len(data)), left.schema)
    assert history.reconcile(left, right).isEmpty()
    other = right.union(spark.createDataFrame([(7, None, "a")] * 2, left.schema)).select("b", "k", "a")
    assert rows(history.reconcile(left, other)) == [(7, None, "a", -2)] and rows(history.reconcile(other, left)) == [("a", 7, None, 2)]
    assert rows(history.reconcile(left, other, buckets=1)) == [(7, None, "a", -2)]
    swapped = spark.createDataFrame([(1, None, "a")], left.schema), spark.createDataFrame([(1, "a", None)], left.schema)
    assert sorted(r.copies for r in history.reconcile(*swapped).collect()) == [-1, 1]
    plan = history.reconcile(left, right)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and "strategy=broadcast" in plan


def test_updates_that_share_a_sequence_are_a_conflict(spark, rows):
    stored = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "k int, s int, v string")
    copies = spark.createDataFrame([(1, 2, "x"), (1, 2, "x"), (1, 1, "old"), (1, 1, "older"), (2, 5, "same time")], stored.schema)
    # Only the greatest sequence of a key decides; the update wins over a stored row of equal sequence.
    assert rows(history.scd1_merge(stored, copies, ["k"], "s")) == [(1, 2, "x"), (2, 5, "same time")]
    for other in ("y", None):
        differing = copies.union(spark.createDataFrame([(1, 2, other)], stored.schema))
        with pytest.raises(Exception, match="share one key and sequence"):
            history.scd1_merge(stored, differing, ["k"], "s").collect()
    with pytest.raises(Exception, match="share one key and sequence"):
        history.scd1_merge(None, copies.union(spark.createDataFrame([(1, 2, "gone")], stored.schema)), ["k"], "s", "v = 'gone'").collect()
    assert history.latest_rows(copies.union(spark.createDataFrame([(1, 2, "y")], stored.schema)), ["k"], "s", conflicts=False).where("k = 1").first().v == "y"


def test_conflicts_are_found_without_sorting(spark):
    frame = spark.createDataFrame([(1, 1, None, "a"), (1, 1, "a", None), (2, 1, "x", "y"), (2, 1, "x", "y"), (3, 1, None, None)], "k int, s int, a string, b string")
    found = history.sequence_conflicts(frame, ["k"], "s")
    assert [tuple(r) for r in found.collect()] == [(1, 1, 2)]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
