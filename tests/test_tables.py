import json

import pytest
from pyspark.sql import functions as F

from relaylog.operators import activity, tables
from relaylog.session import shared_dir

SUBS = "destination_id string, desired string, revision long"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_ensure_subscriptions(spark):
    stored = spark.createDataFrame([("a", "paused", 4)], SUBS)
    ids = spark.createDataFrame([("a",), ("b",), ("b",)], "destination_id string")
    once = tables.ensure_subscriptions(stored, ids, ["destination_id"])
    assert rows(once, *once.columns) == [("a", "paused", 4), ("b", "running", 1)]
    assert rows(tables.ensure_subscriptions(once, ids, ["destination_id"]), *once.columns) == rows(once, *once.columns)


@pytest.mark.parametrize("chunk", [2, 1000])
def test_fold_desired(spark, chunk):
    stored = spark.createDataFrame([("a", "running", 1), ("b", "paused", 3), ("c", "running", 1)], SUBS)
    log = [
        ("a", 1, "running"), ("a", 2, "paused"), ("a", 3, "paused"), ("a", 4, "noise"), ("a", 5, "running"), ("a", 6, "paused"),
        ("b", 7, "paused"), ("unknown", 8, "paused"),
    ]
    commands = spark.createDataFrame(log, "destination_id string, seq long, state string")
    got = tables.fold_desired(stored, commands, ["destination_id"], chunk)
    assert rows(got, "destination_id", "desired", "revision") == [("a", "paused", 4), ("b", "paused", 3), ("c", "running", 1)]


def test_observations(spark):
    seen = [("w", "d", 2, 1, "paused"), ("w", "d", 1, 2, "running"), ("w", "d", 2, 3, "running"), ("v", "d", 1, 4, "running")]
    obs = spark.createDataFrame(seen, "worker string, destination_id string, revision long, arrival long, state string")
    latest = tables.latest_by_revision(obs, ["worker", "destination_id"])
    assert rows(latest, "worker", "revision", "state") == [("v", 1, "running"), ("w", 2, "running")]

    def observed(members, revision):
        wanted = spark.createDataFrame([("d", m, revision, "running") for m in members], "destination_id string, worker string, r long, s string")
        got = tables.observed_everywhere(wanted, latest, ["destination_id"], "worker", "r", "s").collect()
        return [r.observed for r in got]

    assert observed(["w"], 2) == [True] and observed(["w", "v"], 2) == [False] and observed(["w", "v"], 1) == [True]
    assert observed(["w", "new"], 1) == [False] and observed([], 1) == []


def test_terminal_everywhere(spark):
    key = "destination_id string, topic string, partition int, offset long"
    routed = spark.createDataFrame([(d, "t", 0, o) for d in "ab" for o in range(3)], key)
    done = spark.createDataFrame(
        [("a", "t", 0, 0, "delivered"), ("b", "t", 0, 0, "filtered"), ("a", "t", 0, 1, "delivered"), ("b", "t", 0, 1, None)],
        key + ", outcome string",
    )
    assert rows(tables.terminal_everywhere(routed, done), "offset", "terminal") == [(0, True), (1, False), (2, False)]


@pytest.mark.parametrize("chunk", [2, 1000])
def test_blocks_latch_and_changes(spark, chunk):
    log = [(1, "running", ""), (2, "running", ""), (3, "blocked", "x"), (4, "blocked", "y"), (5, "running", ""), (6, "running", None)]
    df = spark.createDataFrame([("s", *r) for r in log], "source_id string, seq long, state string, reason string")
    assert rows(tables.latch_blocks(df), "source_id", "reason") == [("s", "y")]
    assert [r[0] for r in rows(tables.state_changes(df, chunk), "seq")] == [1, 3, 4, 5, 6]


def test_health(spark):
    def status(sources, subscriptions):
        frames = [spark.createDataFrame([(x,) for x in states], "state string") for states in (sources, subscriptions)]
        return tables.health_rollup(*frames).first().status

    assert status(["running"], ["running", "paused"]) == "ready"
    assert status(["running", "blocked"], ["running"]) == "degraded"
    assert status(["running"], ["starting"]) == "degraded"
    assert status([None], ["running"]) == "degraded"


def test_state_versions(spark):
    path = shared_dir(spark, "state")
    schema = "k int, v string"
    assert tables.read_state(spark, path, schema).count() == 0
    tables.merge_table(path, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["k"])
    got = tables.merge_table(path, spark.createDataFrame([(2, "c"), (3, "d")], schema), ["k"], "insert")
    assert rows(got, "k", "v") == [(1, "a"), (2, "b"), (3, "d")]
    got = tables.merge_table(path, spark.createDataFrame([(2, "c")], schema), ["k"], "upsert")
    assert rows(got, "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    # An unfinished write is not a version.
    fs, folder = tables.hadoop_path(spark, f"{path}/v={99:020d}")
    fs.mkdirs(folder)
    assert rows(tables.read_state(spark, path, schema), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def log_of(spark, n):
    return spark.range(1, n + 1).select(F.col("id").alias("sequence"), F.col("id").cast("string").alias("event_id"))


def test_activity_window_and_cursors(spark):
    log = log_of(spark, 1005)
    kept = activity.retain_last(log).collect()
    assert len(kept) == 1000 and kept[0].sequence == 6 and kept[-1].sequence == 1005

    def read(log, cursor):
        entries, following, reset = activity.read_after(log, "boot", cursor)
        found = [r.sequence for r in entries.collect()]
        return len(found), (found or [None])[0], following, reset

    assert read(log, "") == (1000, 6, "boot:1005", False)
    assert read(log, "boot:1005") == (0, None, "boot:1005", False)
    assert read(log, "boot:1004") == (1, 1005, "boot:1005", False)
    assert read(log, "boot:5") == (1000, 6, "boot:1005", False)
    assert read(log, "boot:4") == (1000, 6, "boot:1005", True)
    assert read(log, "boot:999999") == (1000, 6, "boot:1005", True)
    assert read(log, "other:1005") == (1000, 6, "boot:1005", True)
    assert read(log_of(spark, 0), "") == (0, None, "boot:0", False)
    for cursor in ("broken", "x:no", "x:-1", "x:1:2", ":1"):
        with pytest.raises(activity.InvalidCursor):
            activity.read_after(log, "boot", cursor)


def test_activity_entries(spark):
    base = ("s", 3, "t", 2)
    schema = (
        "source_id string, generation int, topic string, partition int, destination_id string, offset long, event_id string, "
        "aggregate_id string, event_name string, outcome string, known_skip boolean, committed boolean"
    )
    records = spark.createDataFrame(
        [
            (*base, "d", 0, "e0", "a", "n", "delivered", False, True),
            (*base, "d", 1, "e1", "a", "n", "filtered", False, True),
            (*base, "d", 2, "e2", "a", "n", "skipped", True, True),
            (*base, "d", 3, "e3", "a", "n", None, False, False),
        ],
        schema,
    )
    attempts = spark.createDataFrame(
        [("d", "t", 2, 0, 0, None), ("d", "t", 2, 0, 1, "delivered"), ("d", "t", 2, 3, 0, None)],
        "destination_id string, topic string, partition int, offset long, attempt int, outcome string",
    )
    entries = activity.activity_entries(records, attempts)
    got = {}
    for r in entries.collect():
        assert (r.source_id, r.destination_id, r.generation, r.event_name) == ("s", "d", 3, "n")
        got.setdefault(r.offset, []).append((r.message, r.level, r.attempt, r.outcome, r.error))
    assert sorted(got[0], key=repr) == [
        ("acknowledged", "info", 2, None, None),
        ("committed", "info", None, None, None),
        ("delivery started", "info", None, None, None),
        ("retry", "warn", 1, None, "delivery failed or retry requested"),
        ("terminal outcome", "info", None, "delivered", None),
    ]
    assert sorted(m for m, *_ in got[1]) == ["committed", "delivery started", "terminal outcome"]
    assert [m for m, *_ in got[2]] == ["committed"]
    assert sorted(m for m, *_ in got[3]) == ["delivery started", "retry"]
    assert activity.find_activity(entries, event_id="e2").count() == 1
    assert activity.find_activity(entries, aggregate_id="a", event_name="n").count() == entries.count()

    path = shared_dir(spark, "activity")
    activity.write_activity(entries, path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines) == entries.count()
    assert all("partition" in line and "offset" in line for line in lines)
    assert not any("outcome" in line for line in lines if line["message"] == "committed")


def test_versions_are_retired_by_age(spark):
    """A lazy frame of an old version can be read as long as that version is young enough."""
    path = shared_dir(spark, "state")
    first = None
    for i in range(tables.KEPT_VERSIONS + 3):
        tables.write_state(spark.range(i, i + 1), path)
        first = first if first is not None else tables.read_state(spark, path, "id bigint")
    assert [r.id for r in first.collect()] == [0]
    tables.write_state(spark.range(99, 100), path, kept_seconds=-60)
    assert [r.id for r in tables.read_state(spark, path, "id bigint").collect()] == [99]
    fs, folder = tables.hadoop_path(spark, path)
    assert len(fs.listStatus(folder)) == tables.KEPT_VERSIONS
