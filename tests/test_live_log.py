"""Live logs: appends, segments, the manifest, byte bounds; replay; deduplication on a stream."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from relaylog.model import Scope, Source
from relaylog.operators import contract, outcomes
from relaylog.operators.tables import hadoop_path
from relaylog.session import shared_dir
from relaylog.sources import changes, segments
from relaylog.streaming.delivery import CapturedSource, DeliveryJob, HistoryLost, start_delivery
from relaylog.streaming.replay import ReplayJob, ReplayRefused, replay_records

SOURCE = Source("events", "Events", "events", ("id", "event_id", "tenant", "event_name"), "id", "tenant")
SCOPE = Scope("ns", "test", 2)
TOPIC = "events.topic"
OK = '{"result":{"success":{}}}'


def table(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").select(
        "id", F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 3).alias("tenant"), F.lit("made").alias("event_name")
    )


@pytest.fixture(scope="module")
def identity(spark):
    rows = spark.createDataFrame([(1, "e1", 1, "n")], "id long, event_id string, tenant long, event_name string")
    return contract.identity_from(rows, SOURCE, 3)


def append(spark, identity, log, ids, **options):
    return segments.append_rows(table(spark, ids), SOURCE, identity, TOPIC, log, F.col("tenant").cast("int"), **options)


def records(spark, log):
    rows = changes.read_changes(spark, log).select("partition", "offset", F.get_json_object("value", "$.after.id").cast("long").alias("id"), F.get_json_object("value", "$.op").alias("op"))
    found = {}
    for r in rows.orderBy("partition", "offset").collect():
        found.setdefault(r["partition"], []).append((r["offset"], r["id"], r["op"]))
    return found


def test_late_smaller_serials_come_last_and_nothing_twice(spark, identity):
    log = shared_dir(spark, "log")
    assert append(spark, identity, log, [2, 5, 8, 11, 3]) == 5
    assert append(spark, identity, log, [2, 5, 8, 11, 3]) == 0
    assert append(spark, identity, log, [1, 2, 3, 5, 8, 11, 14, 20]) == 3
    assert append(spark, identity, log, [17, 2]) == 1
    assert records(spark, log) == {
        0: [(0, 3, "r")],
        1: [(0, 1, "c")],
        2: [(0, 2, "r"), (1, 5, "r"), (2, 8, "r"), (3, 11, "r"), (4, 14, "c"), (5, 20, "c"), (6, 17, "c")],
    }


def test_settled_serials_are_not_read(spark, identity):
    log = shared_dir(spark, "log")
    append(spark, identity, log, [3, 6, 9])
    assert append(spark, identity, log, [3, 6, 7, 9, 12], settled=8) == 1  # 7 was said to be captured
    plan = segments.new_rows(spark, table(spark, [9]), SOURCE, TOPIC, log, 8)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(serial,8)" in plan


def staged(spark, log):
    return sorted(os.listdir(f"{log}/_staging")) if os.path.isdir(f"{log}/_staging") else []


def test_a_segment_that_was_cut_off_while_moved_is_finished(spark, identity, monkeypatch):
    log = shared_dir(spark, "log")
    append(spark, identity, log, [3, 6])
    real = segments.publish
    monkeypatch.setattr(segments, "publish", lambda *a: None)  # the writer dies once its segment is complete
    append(spark, identity, log, [9, 12, 15, 4], segment_records=2)
    assert records(spark, log) == {0: [(0, 3, "r"), (1, 6, "r")]}
    monkeypatch.setattr(segments, "publish", real)
    assert append(spark, identity, log, [3, 4, 6, 9, 12, 15, 18]) == 1
    assert records(spark, log) == {0: [(0, 3, "r"), (1, 6, "r"), (2, 9, "c"), (3, 12, "c"), (4, 15, "c"), (5, 18, "c")], 1: [(0, 4, "c")]}
    assert staged(spark, log) == []


def test_a_segment_that_was_never_complete_is_dropped_and_its_rows_stay_new(spark, identity):
    log = shared_dir(spark, "log")
    append(spark, identity, log, [3])
    half = changes.encode_changes(table(spark, [6]).withColumn("partition", F.lit(0)).withColumn("offset", F.lit(1)), SOURCE, identity, TOPIC)
    half.write.partitionBy("topic", "partition").parquet(f"{log}/_staging/dead")
    os.remove(f"{log}/_staging/dead/_SUCCESS")
    assert append(spark, identity, log, [3, 6, 9]) == 2
    assert records(spark, log) == {0: [(0, 3, "r"), (1, 6, "c"), (2, 9, "c")]}
    assert staged(spark, log) == []


def test_files_become_visible_in_offset_order(spark, identity, monkeypatch):
    log = shared_dir(spark, "log")
    moved = []
    real = segments.hadoop_path

    def watched(spark, path):
        fs, target = real(spark, path)

        class Fs:
            def __getattr__(self, name):
                if name != "rename":
                    return getattr(fs, name)
                return lambda a, b: moved.append(str(b)) or fs.rename(a, b)

        return Fs(), target

    monkeypatch.setattr(segments, "hadoop_path", watched)
    append(spark, identity, log, list(range(0, 90, 3)), segment_records=4)
    assert len(moved) == 8
    firsts = [spark.read.parquet(m).agg(F.min("offset"), F.max("offset")).first() for m in moved]
    assert [tuple(f) for f in firsts] == [(i, min(i + 3, 29)) for i in range(0, 30, 4)]


def test_a_table_without_new_rows_and_an_empty_one(spark, identity):
    log = shared_dir(spark, "log")
    assert segments.append_rows(table(spark, [1]).filter("id > 5"), SOURCE, identity, TOPIC, log) == 0
    assert segments.log_bounds(spark, log).isEmpty()
    assert segments.read_range(spark, log, [(TOPIC, 0, 0, 5)]).isEmpty()


def test_bounds_open_no_file_that_has_an_entry_and_scan_the_others(spark, identity):
    log = shared_dir(spark, "log")
    append(spark, identity, log, list(range(1, 40)), segment_records=5)
    plan = segments.log_bounds(spark, log)._jdf.queryExecution().executedPlan().toString()
    assert "offset" not in plan.replace("first_offset", "").replace("end_offset", "")
    other = changes.encode_changes(table(spark, [300]).withColumn("partition", F.lit(0)).withColumn("offset", F.lit(13)), SOURCE, identity, TOPIC)
    changes.write_changes(other, log)
    scan = lambda: sorted(map(tuple, changes.log_bounds(changes.read_changes(spark, log)).collect()))
    assert sorted(map(tuple, segments.log_bounds(spark, log).collect())) == scan()
    assert segments.index_log(spark, log) == 1 and segments.index_log(spark, log) == 0
    assert sorted(map(tuple, segments.log_bounds(spark, log).collect())) == scan()
    # A file that retention took away does not count any more.
    [gone] = segments.manifest(spark, log).filter("partition = 0 and first_offset = 0").collect()
    fs, target = hadoop_path(spark, f"{log}/{gone['file']}")
    fs.delete(target, False)
    assert sorted(map(tuple, segments.log_bounds(spark, log).collect())) == scan()
    assert (TOPIC, 0, 5, 14) in scan()


def test_the_manifest_is_written_together_now_and_then(spark, identity, monkeypatch):
    monkeypatch.setattr(segments, "_COMPACT", 2)
    log = shared_dir(spark, "log")
    for i in range(5):
        append(spark, identity, log, [3 * i])
    assert len([f for f in os.listdir(f"{log}/_manifest") if f.endswith(".parquet")]) <= 3
    assert [tuple(r) for r in segments.log_bounds(spark, log).collect()] == [(TOPIC, 0, 0, 5)]


def test_range_reads_open_only_files_that_can_hold_the_range(spark, identity):
    log = shared_dir(spark, "log")
    append(spark, identity, log, list(range(0, 300, 3)), segment_records=10)
    found = segments.read_range(spark, log, [(TOPIC, 0, 25, 42)])
    assert len(found.inputFiles()) == 3
    assert sorted(r["offset"] for r in found.collect()) == list(range(25, 42))


def test_a_segment_of_many_files_is_staged_in_few_folders(spark, identity, monkeypatch):
    """A folder, a look-up of a class or a search for each file took longer than the records."""
    log = shared_dir(spark, "log")
    with monkeypatch.context() as m:
        m.setattr(segments, "publish", lambda *a: None)
        append(spark, identity, log, list(range(0, 300, 3)), segment_records=10)
    [segment] = os.listdir(f"{log}/_staging")
    assert os.listdir(f"{log}/_staging/{segment}/topic={TOPIC}/partition=0") == ["chunk=0"]
    segments.publish(spark, log)
    read = []
    real = segments._records_of
    monkeypatch.setattr(segments, "_records_of", lambda spark, path, places: read.append(places) or real(spark, path, places))
    assert segments.index_log(spark, log) == 10 and read == [[f"topic={TOPIC}/partition=0"]]
    entries = segments.manifest(spark, log).orderBy("file").collect()
    assert [(e["first_offset"], e["end_offset"], e["records"]) for e in entries] == [(i, i + 10, 10) for i in range(0, 100, 10)]


def test_a_log_with_files_of_other_writers_is_read_by_folder_only_where_all_are_new(spark, identity):
    listed = ["t=1/p=0/a", "t=1/p=0/b", "t=1/p=1/a", "t=1/p=1/b", "t=1/p=1/c"]
    assert segments._by_folder(["t=1/p=0/a", "t=1/p=0/b", "t=1/p=1/c"], listed) == ["t=1/p=0", "t=1/p=1/c"]
    assert segments._by_folder(["t=1/p=1/a", "t=1/p=1/b"], listed, 0.5) == ["t=1/p=1"]


def test_a_range_over_many_files_is_read_by_folder_and_holds_its_records_only(spark, identity, monkeypatch):
    log = shared_dir(spark, "log")
    append(spark, identity, log, list(range(0, 300, 3)) + list(range(1, 61, 3)), segment_records=10)
    monkeypatch.setattr(segments, "_LISTED", 2)
    read = []
    real = segments._records_of
    monkeypatch.setattr(segments, "_records_of", lambda spark, path, places: read.append(places) or real(spark, path, places))
    found = segments.read_range(spark, log, [(TOPIC, 0, 25, 75), (TOPIC, 1, 3, 5)])
    assert sorted((r["partition"], r["offset"]) for r in found.collect()) == [(0, i) for i in range(25, 75)] + [(1, 3), (1, 4)]
    assert read == [[f"topic={TOPIC}/partition=0", f"topic={TOPIC}/partition=1"]]


# -- byte bounds ----------------------------------------------------------------------------------------------------


def raw(spark, sizes, partition=0):
    rows = [(TOPIC, partition, i, "", "x" * n) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")


def test_bytes_cut_a_prefix_with_one_record_at_least(spark):
    df = raw(spark, [40, 40, 40]).unionByName(raw(spark, [500, 1], 1)).unionByName(raw(spark, [0, 0, 90, 20], 2)).unionByName(raw(spark, [100], 3))
    cut = segments.within_bytes(df, 100)
    assert sorted((r["partition"], r["offset"]) for r in cut.collect()) == [(0, 0), (0, 1), (1, 0), (2, 0), (2, 1), (2, 2), (3, 0)]
    null = df.limit(1).withColumn("value", F.lit(None).cast("string"))
    assert segments.within_bytes(null, 0).count() == 1


def accepting():
    def send(body, headers):
        return 200, OK

    return send


def sleepless():
    def sleep(_):
        return None

    return sleep


def job(spark, identity, log, state, kind=DeliveryJob, sender=None, **options):
    from relaylog.model import Destination

    destination = Destination("projection", "Projection", ("events",))
    return kind(spark, SCOPE, [CapturedSource(SOURCE, identity, TOPIC)], destination, sender or accepting(), log, state, sleep=sleepless(), **options)


def test_a_huge_record_has_a_round_of_its_own(spark, identity):
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    rows = table(spark, [0, 3, 6, 9]).withColumn("event_name", F.when(F.col("id") == 3, F.repeat(F.lit("h"), 5_000)).otherwise(F.col("event_name")))
    segments.append_rows(rows, SOURCE, identity, TOPIC, log, F.col("tenant").cast("int"))
    delivery = job(spark, identity, log, state, round_bytes=400)
    delivery._take(delivery._bounds(), at_start=False)
    reached = []
    while delivery.round():
        reached.append(delivery.positions().first()["committed"])
    assert reached == [1, 2, 4]
    assert delivery.outcomes().filter("outcome = 'delivered'").count() == 4


def test_micro_batches_bounded_by_bytes(spark, identity):
    log = shared_dir(spark, "log")
    append(spark, identity, log, list(range(0, 60, 3)), segment_records=5)
    stream = changes.read_changes_stream(spark, log, bytes_per_trigger=1)
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert spark.read.parquet(out).count() == 20


# -- replay ---------------------------------------------------------------------------------------------------------


def noting(folder, stuck=()):
    def send(body, headers):
        with open(os.path.join(folder, headers["X-Relay-Partition"]), "a") as f:
            f.write(f"{headers['X-Relay-Offset']} {headers['X-Relay-Replay']}\n")
        return (503, "") if int(headers["X-Relay-Offset"]) in stuck else (200, OK)

    return send


def noted(folder):
    return {int(n): [line.split() for line in open(os.path.join(folder, n)).read().splitlines()] for n in os.listdir(folder)}


@pytest.fixture
def delivered(spark, identity):
    """A log of 20 records in partition 0, and a state in which normal delivery has gone through it."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    append(spark, identity, log, list(range(0, 60, 3)))
    normal = job(spark, identity, log, state)
    start_delivery(normal, available_now=True).awaitTermination()
    return log, state, normal


def committed(delivery):
    return {r["partition"]: r["committed"] for r in delivery.positions().collect()}


def test_bounded_replay_sends_its_range_in_order_and_touches_nothing_else(spark, identity, delivered, tmp_path):
    log, state, normal = delivered
    replay = job(spark, identity, log, state, ReplayJob, noting(str(tmp_path)), replay_id="a", round_size=4)
    replay.create({(TOPIC, 0): 5}, {(TOPIC, 0): 15}, fresh_target=True, revision="r7")
    assert replay.status()["state"] == "created" and replay.status()["revision"] == "r7" and not os.listdir(tmp_path)
    assert replay.run() == "completed"
    assert noted(tmp_path) == {0: [[str(i), "true"] for i in range(5, 15)]}
    assert committed(replay) == {0: 15} and committed(normal) == {0: 20}
    assert normal.outcomes().count() == 20 and replay.outcomes().count() == 10
    with pytest.raises(ReplayRefused, match="completed"):
        replay.run()
    with pytest.raises(ReplayRefused, match="exists"):
        replay.create(fresh_target=True)


def test_replay_goes_on_after_a_pause_and_a_restart(spark, identity, delivered, tmp_path):
    log, state, _ = delivered
    first = job(spark, identity, log, state, ReplayJob, noting(str(tmp_path), stuck=(9,)), replay_id="a", max_attempts=1)
    first.create(ends={(TOPIC, 0): 12}, fresh_target=True)
    assert first.run() == "running" and committed(first) == {0: 9}  # one record keeps asking for a retry
    first.pause()
    assert first.status()["state"] == "paused" and not first.round()
    second = job(spark, identity, log, state, ReplayJob, noting(str(tmp_path)), replay_id="a")
    assert second.run() == "completed" and committed(second) == {0: 12}
    sent = [int(o) for o, _ in noted(tmp_path)[0]]
    assert sorted(set(sent)) == list(range(12)) and sent[-3:] == [9, 10, 11]


def test_cancelled_replay_does_not_go_on(spark, identity, delivered):
    log, state, _ = delivered
    replay = job(spark, identity, log, state, ReplayJob, replay_id="a")
    replay.create(fresh_target=True)
    replay.cancel()
    for act in (replay.run, replay.pause, lambda: replay._move("running")):
        with pytest.raises(ReplayRefused, match="cancelled"):
            act()
    assert replay.outcomes().isEmpty()


def test_what_may_not_be_created(spark, identity, delivered):
    log, state, _ = delivered
    make = lambda name: job(spark, identity, log, state, ReplayJob, replay_id=name)
    with pytest.raises(ReplayRefused, match="fresh"):
        make("a").create()
    for starts, ends in (({(TOPIC, 0): 21}, None), ({(TOPIC, 0): 8}, {(TOPIC, 0): 7}), (None, {(TOPIC, 0): 21}), ({(TOPIC, 2): 0}, None)):
        with pytest.raises(ReplayRefused, match="log"):
            make("b").create(starts, ends, fresh_target=True)
    with pytest.raises(ReplayRefused, match="not created"):
        make("c").run()
    with pytest.raises(ValueError, match="id"):
        make("x/y")


def test_lost_history_and_other_identities_block_a_replay_only(spark, identity, delivered):
    log, state, normal = delivered
    replay = job(spark, identity, log, state, ReplayJob, replay_id="a")
    replay.create(fresh_target=True)
    other = contract.identity_from(spark.createDataFrame([(1, "e", "t", "n")], "id long, event_id string, tenant string, event_name string"), SOURCE, 3)
    with pytest.raises(ReplayRefused, match="created for"):
        job(spark, other, log, state, ReplayJob, replay_id="a").run()
    assert replay.status()["state"] == "blocked"
    second = job(spark, identity, log, state, ReplayJob, replay_id="b")
    second.create(fresh_target=True)
    for f in segments.manifest(spark, log).collect():
        fs, target = hadoop_path(spark, f"{log}/{f['file']}")
        fs.delete(target, False)
    with pytest.raises(HistoryLost):
        second.run()
    assert second.status()["state"] == "blocked" and normal.blocked().isEmpty()


def test_following_replay_reaches_its_boundary_and_goes_on(spark, identity, delivered, tmp_path):
    log, state, normal = delivered
    replay = job(spark, identity, log, state, ReplayJob, noting(str(tmp_path)), replay_id="a")
    replay.create({(TOPIC, 0): 18}, follow=True, fresh_target=True)
    assert replay.run() == "following" and committed(replay) == {0: 20}
    append(spark, identity, log, [600, 603, 1])
    again = job(spark, identity, log, state, ReplayJob, noting(str(tmp_path)), replay_id="a")
    again.start(available_now=True).awaitTermination()
    assert committed(again) == {0: 22, 1: 1} and again.status()["state"] == "following"
    assert noted(tmp_path) == {0: [[str(i), "true"] for i in range(18, 22)], 1: [["0", "true"]]}
    assert committed(normal) == {0: 20}
    bounded = job(spark, identity, log, state, ReplayJob, replay_id="b")
    bounded.create(fresh_target=True)
    with pytest.raises(ReplayRefused, match="run, not started"):
        bounded.start()


def test_replayed_records_without_ranges_are_none(spark):
    rows = spark.createDataFrame([(TOPIC, 0, i, False) for i in range(5)], "topic string, partition int, offset long, replay boolean")
    assert replay_records(rows, []).isEmpty()
    assert [(r["offset"], r["replay"]) for r in replay_records(rows, [(TOPIC, 0, 1, 3)]).collect()] == [(1, True), (2, True)]


# -- deduplication on a stream --------------------------------------------------------------------------------------


def test_a_stream_keeps_one_row_a_key_and_forgets_keys_behind_the_watermark(spark):
    path, out, checkpoint = (shared_dir(spark, n) for n in ("in", "out", "checkpoint"))
    schema = "idempotency_key string, at timestamp, n int"
    at = lambda hours: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)

    def receive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)
        unique = outcomes.dedupe_deliveries(spark.readStream.schema(schema).parquet(path), "at", "2 hours")
        query = unique.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out)
        query.awaitTermination()
        return query

    receive(("a", at(0), 1), ("b", at(0), 2), ("a", at(1), 3))
    receive(("a", at(1), 4), ("c", at(2), 5))
    receive(("d", at(50), 6))
    last = receive(("a", at(1), 7), ("e", at(51), 8))  # far behind the watermark: dropped, though its key is forgotten
    got = [(r["idempotency_key"], r["n"]) for r in spark.read.schema(schema).parquet(out).collect()]
    assert sorted(k for k, _ in got) == ["a", "b", "c", "d", "e"] and ("a", 7) not in got
    assert last.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
