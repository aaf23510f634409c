import http.client
import io
import json
import os
import threading
import urllib.error
import urllib.response
from email.message import Message

import pytest
from pyspark.sql import functions as F

from relaylog.model import Destination, Filter, Scope, Source
from relaylog.operators import contract, outcomes
from relaylog.operators.deliver import deliver, http_sender
from relaylog.session import shared_dir
from relaylog.sources import changes
from relaylog.streaming.delivery import CapturedSource, DeliveryJob, HistoryLost, apply_desired, start_delivery

SCOPE = Scope("ns", "test", 2)
SOURCE = Source("events", "Events", "events", ("id", "event_id", "tenant", "event_name"), "id", "tenant")
OK = '{"result":{"success":{}}}'
KEEP = '{"result":{"error":{"policy":"keep_going","class":"c","description":"d"}}}'
TOPIC = "events.topic"


def without_sleep():
    # A local function: executors get it by value and need not import this file.
    def sleep(_):
        return None

    return sleep


def recording_sender(folder, stuck=(), skipped=(), flaky=()):
    """Answers by event id; every call leaves a line in a file per log partition, in order."""

    def send(body, headers):
        payload = json.loads(body)["payload"]
        place = os.path.join(folder, headers["X-Relay-Partition"])
        before = open(place).read() if os.path.exists(place) else ""
        with open(place, "a") as f:
            f.write(f"{payload['id']} {headers['X-Relay-Offset']}\n")
        if payload["id"] in stuck:
            return 503, ""
        if payload["id"] in flaky and f"{payload['id']} " not in before:
            return None, ""
        return 200, KEEP if payload["id"] in skipped else OK

    return send


def calls(folder):
    found = {}
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            found[int(name)] = [tuple(map(int, line.split())) for line in f]
    return found


def rows(spark, first, last):
    return spark.range(first, last).select(
        "id",
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.concat(F.lit("t"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("tenant"),
        F.when(F.col("id") % 4 == 0, "Deleted").otherwise("Created").alias("event_name"),
    )


@pytest.fixture(scope="module")
def identity(spark):
    return contract.identity_from(rows(spark, 0, 1), SOURCE, 3)


def log_rows(spark, identity, n):
    """The first ``n`` records of the log; a longer log begins with the shorter one."""
    return changes.encode_changes(changes.assign_positions(rows(spark, 0, n), identity), SOURCE, identity, TOPIC)


class Setup:
    def __init__(self, spark, identity, tmp_path, **kw):
        self.spark, self.identity = spark, identity
        self.log = shared_dir(spark, "log")
        self.folder = str(tmp_path / "calls")
        os.makedirs(self.folder)
        self.written = 0
        self.options = {"state_path": shared_dir(spark, "state"), "sleep": without_sleep(), "max_attempts": 2, **kw}

    def append(self, n):
        new = log_rows(self.spark, self.identity, n)
        placed = new.withColumn("id", F.get_json_object("value", "$.after.id").cast("long"))
        changes.write_changes(placed.filter(F.col("id") >= self.written).drop("id"), self.log)
        self.written = n

    def job(self, destination=None, **behaviour):
        destination = destination or Destination("d", "D", ("events",), Filter("event_name", ("Created",)))
        sources = [CapturedSource(SOURCE, self.identity, TOPIC)]
        sender = recording_sender(self.folder, **behaviour)
        return DeliveryJob(self.spark, SCOPE, sources, destination, sender, self.log, **self.options)

    def run(self, job):
        start_delivery(job, available_now=True).awaitTermination()
        return {(r.partition, r.offset): r.outcome for r in job.outcomes().collect()}

    def expected(self, job):
        placed = changes.assign_positions(rows(self.spark, 0, self.written), self.identity).collect()
        return {(r.partition, r.offset): r for r in placed}


@pytest.fixture
def setup(spark, identity, tmp_path):
    return Setup(spark, identity, tmp_path)


def test_deliver_in_order_and_stop(spark, identity, tmp_path):
    folder = str(tmp_path)
    decoded = rows(spark, 0, 60).transform(lambda d: changes.assign_positions(d, identity))
    requests = decoded.select(
        F.lit("d").alias("destination_id"), F.lit(TOPIC).alias("topic"), "partition", "offset",
        F.when(F.col("event_name") == "Deleted", "filtered").alias("outcome"),
        F.to_json(F.struct(F.struct("id").alias("payload"))).alias("body"),
        F.create_map(F.lit("X-Relay-Partition"), F.col("partition").cast("string"), F.lit("X-Relay-Offset"), F.col("offset").cast("string")).alias("headers"),
    )
    path = shared_dir(spark, "sent")
    deliver(requests, recording_sender(folder, stuck={7}, skipped={10}, flaky={11}), 2, 12, without_sleep()).write.parquet(path)
    sent = {(r.partition, r.offset): r for r in spark.read.parquet(path).collect()}
    placed = {r.id: r for r in decoded.collect()}
    stuck = placed[7]
    for r in placed.values():
        found = sent.get((r.partition, r.offset))
        if r.partition == stuck.partition and r.offset > stuck.offset:
            assert found is None
        elif r.id == 7:
            assert found.outcome is None and [a.retry_reason for a in found.attempts] == ["destination returned HTTP 503"] * 2
        elif r.id % 4 == 0:
            assert found.outcome == "filtered" and found.attempts == []
        else:
            assert found.outcome == ("skipped" if r.id == 10 else "delivered")
            assert len(found.attempts) == (2 if r.id == 11 else 1)
    for lines in calls(folder).values():
        offsets = [o for _, o in lines]
        assert offsets == sorted(offsets)
    # One task per log partition: AQE must not merge them.
    plan = deliver(requests, without_sleep(), 2, 12, without_sleep())._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_records_without_a_log_partition_hold_up_nothing(spark, tmp_path):
    requests = spark.createDataFrame([("d", TOPIC, p, o, None, '{"payload": {"id": 7}}', {"X-Relay-Partition": "0", "X-Relay-Offset": str(o)}, f"e{o}") for p in (None, 1) for o in range(3)],
        "destination_id string, topic string, partition int, offset long, outcome string, body string, headers map<string,string>, event_id string")
    sent = deliver(requests, recording_sender(str(tmp_path), stuck={7}), 1, 2, without_sleep(), keep=["event_id"]).collect()
    assert sorted(((r.partition, r.offset, r.event_id, r.outcome) for r in sent), key=str) == [(1, 0, "e0", None), (None, 0, "e0", None), (None, 1, "e1", None), (None, 2, "e2", None)]


def test_stream_delivers_everything_once_in_order(setup):
    setup.append(50)
    job = setup.job(skipped={10}, flaky={11})
    setup.run(job)
    setup.append(120)
    got = setup.run(job)
    want = {
        k: "filtered" if r.event_name == "Deleted" else "skipped" if r.id == 10 else "delivered"
        for k, r in setup.expected(job).items()
    }
    assert got == want
    for lines in calls(setup.folder).values():
        assert [o for _, o in lines] == sorted(o for _, o in lines)
        assert len(lines) == len(set(lines)) + sum(i == 11 for i, _ in set(lines))
    assert [r.offset for r in job.skips().collect()] == [k[1] for k, r in setup.expected(job).items() if r.id == 10]
    # Nothing new: a further run sends nothing.
    before = calls(setup.folder)
    assert setup.run(job) == want and calls(setup.folder) == before
    messages = setup.spark.read.json(job.path("rounds/*/activity")).groupBy("message").count().collect()
    assert {r.message: r["count"] for r in messages} == {
        "delivery started": 120, "terminal outcome": 120, "committed": 120, "acknowledged": 90, "retry": 1,
    }


def test_small_rounds_reach_the_end(spark, identity, tmp_path):
    setup = Setup(spark, identity, tmp_path, round_size=15)
    setup.append(60)
    job = setup.job()
    assert len(setup.run(job)) == 60
    assert {r.partition: r.committed for r in job.positions().collect()} == {
        r.partition: r.n for r in changes.read_changes(spark, setup.log).groupBy("partition").agg(F.count("*").alias("n")).collect()
    }


def test_stuck_record_holds_its_partition_until_it_succeeds(setup):
    setup.append(60)
    got = setup.run(setup.job(stuck={7}))
    placed = setup.expected(None)
    place = next(k for k, r in placed.items() if r.id == 7)
    finished = {k for k, outcome in got.items() if outcome}
    assert finished == {k for k in placed if k[0] != place[0] or k[1] < place[1]}
    # The destination recovers: the tail goes out, first the stuck record, though nothing new arrived.
    got = setup.run(setup.job())
    assert set(got) == set(placed) and all(got.values())


def test_failing_rounds_count_on_and_keep_their_activity(setup):
    setup.append(60)
    for _ in range(2):
        got = setup.run(setup.job(stuck={7}))
    entries = setup.spark.read.json(setup.job().path("rounds/*/activity")).filter("event_id = 'e7'").collect()
    tries = sorted(r.attempt for r in entries if r.message == "retry")
    assert len(tries) >= 6 and tries == list(range(1, len(tries) + 1))
    assert sum(r.message == "delivery started" for r in entries) == 1
    place = next(k for k, r in setup.expected(None).items() if r.id == 7)
    position = setup.job().positions().filter(F.col("partition") == place[0]).first()
    assert (position.committed, position.tried) == (place[1], len(tries)) and got[place] is None
    # It succeeds in the end, with the next number; then nothing is counted for its partition.
    job = setup.job()
    setup.run(job)
    mine = [r for r in job.activity().collect() if r.event_id == "e7"]
    assert [r.attempt for r in mine if r.message == "acknowledged"] == [len(tries) + 1]
    assert {r.tried for r in job.positions().collect()} == {0}
    stamps = sorted(r.sequence for r in job.activity().collect())
    assert stamps == list(range(1, len(stamps) + 1)) == list(range(1, job.sequence + 1))
    # The records of finished rounds are gone, what was sent and logged stays.
    assert not [f for f in os.listdir(job.path("rounds")) if os.path.exists(job.path(f"rounds/{f}/records"))]


def test_a_new_partition_may_arrive_in_any_order(setup):
    """A micro-batch that holds a later file of a partition never seen before: its start is read from the log."""
    setup.append(60)
    job = setup.job()
    seen = changes.log_bounds(log_rows(setup.spark, setup.identity, 60).filter("offset >= 3")).collect()
    assert all(r.first_offset == 3 for r in seen)
    job._take(job._whole(seen), at_start=False)
    assert {r.first_offset for r in job.positions().collect()} == {0}
    job.drain()
    assert set(setup.run(job)) == set(setup.expected(job))


def test_many_partitions_make_no_deep_plan(setup):
    setup.append(30)
    job = setup.job()
    many = setup.spark.range(5000).select(F.lit(TOPIC).alias("topic"), F.col("id").cast("int").alias("partition"), F.lit(0).alias("first_offset"), F.lit(1).alias("end_offset"))
    job._take(many, at_start=False)
    job.round()
    assert job.outcomes().count() == 3 and job.positions().filter("committed = 1").count() == 3


def test_blocks_of_many_writers_all_stand(setup):
    jobs = [setup.job(Destination(f"d{i}", "D", ("events",))) for i in range(3)]
    for i, job in enumerate(jobs):
        job._store_blocks(setup.spark.createDataFrame([("events" if i < 2 else "other", i, f"why {i}")], "source_id string, seq bigint, reason string"))
    assert {(r.source_id, r.reason) for r in jobs[0].blocked().collect()} == {("events", "why 1"), ("other", "why 2")}
    assert jobs[0].down() == ["events"]


def test_compaction_changes_nothing(setup, monkeypatch):
    monkeypatch.setattr("relaylog.streaming.delivery._COMPACT", 1)
    job = setup.job(skipped={1, 10, 22})
    for n in (20, 40, 60):
        setup.append(n)
        setup.run(job)
    before, skips = job.outcomes().collect(), job.skips().collect()
    job.compact()
    assert sorted(job.outcomes().collect()) == sorted(before) and sorted(job.skips().distinct().collect()) == sorted(skips)
    folders = [f for f in os.listdir(job.path("rounds")) if os.path.exists(job.path(f"rounds/{f}/sent"))]
    assert len(folders) == 1


def test_compaction_while_running_keeps_what_readers_have_listed(setup, monkeypatch):
    monkeypatch.setattr("relaylog.streaming.delivery._COMPACT", 2)
    job = setup.job(skipped={1, 10, 22})
    job.round_size = 4
    setup.append(60)
    got = setup.run(job)
    assert set(got) == set(setup.expected(job)) and job.skips().count() == 3
    listed = job._replaced
    assert listed and all(os.path.exists(path.removeprefix("file:")) for path in listed)


def test_bad_record_blocks_the_source_for_every_destination(setup):
    setup.append(60)
    placed = setup.expected(None)
    last = max(k[1] for k in placed if k[0] == 0)
    bad = setup.spark.createDataFrame([(TOPIC, 0, last + 1, "{}", "{}")], "topic string, partition int, offset long, key string, value string")
    changes.write_changes(bad, setup.log)
    job = setup.job()
    got = setup.run(job)
    assert set(got) == set(placed)
    assert [(r.source_id, r.reason) for r in job.blocked().collect()] == [("events", 'payload: envelope is missing "op"')]
    other = setup.job(Destination("other", "Other", ("events",)))
    assert setup.run(other) == {}


def test_stored_skip_suppresses_only_history(setup):
    setup.append(30)
    job = setup.job()
    placed = setup.expected(None)
    first = next(k for k, r in placed.items() if r.id == 1)
    skip = setup.spark.createDataFrame([("d", "events", "e1", TOPIC, *first)], "destination_id string, source_id string, event_id string, topic string, partition int, offset long")
    skip.write.parquet(job.path("skips"))
    got = setup.run(job)
    assert got[first] == "skipped"
    assert 1 not in {i for lines in calls(setup.folder).values() for i, _ in lines}
    assert job.skips().count() == 1


def test_rounds_are_decoded_together_and_committed_one_by_one(spark, identity, tmp_path, monkeypatch):
    """Decoding, planned anew for every round, took longer than the rest of the round."""
    setup = Setup(spark, identity, tmp_path, round_size=4)
    setup.append(60)
    setup.append(60)
    changes.write_changes(log_rows(spark, identity, 60).filter("offset = 2"), setup.log)  # a position counts once
    job, decoded, steps = setup.job(), [], []
    ahead, advance = DeliveryJob._decode_ahead, DeliveryJob._advance
    monkeypatch.setattr(DeliveryJob, "_decode_ahead", lambda self, *a: decoded.append(1) or ahead(self, *a))
    monkeypatch.setattr(DeliveryJob, "_advance", lambda self, sent, state: steps.append(sent.groupBy("partition").count().collect()) or advance(self, sent, state))
    got = setup.run(job)
    assert set(got) == set(setup.expected(job)) and all(got.values())
    assert len(steps) > 3 * len(decoded) and max(r["count"] for step in steps for r in step) == 4
    assert sorted(o for lines in calls(setup.folder).values() for o in lines) == sorted(set(o for lines in calls(setup.folder).values() for o in lines))
    assert not os.path.exists(job.path("ahead"))


def test_a_block_stops_the_rounds_that_are_decoded_with_it(spark, identity, tmp_path):
    setup = Setup(spark, identity, tmp_path, round_size=4)
    placed = log_rows(spark, identity, 60)
    changes.write_changes(placed.withColumn("value", F.when((F.col("partition") == 0) & (F.col("offset") == 6), "{}").otherwise(F.col("value"))), setup.log)
    job = setup.job()
    got = setup.run(job)
    ends = {r.partition: r["count"] for r in placed.groupBy("partition").count().collect()}
    assert set(got) == {(p, o) for p, n in ends.items() for o in range(min(n, 8)) if p or o < 6}
    assert [r.source_id for r in job.blocked().collect()] == ["events"] and not os.path.exists(job.path("ahead"))


def test_bytes_bound_the_rounds_that_are_decoded_together(spark, identity, tmp_path):
    setup = Setup(spark, identity, tmp_path)
    placed = log_rows(spark, identity, 60)
    changes.write_changes(placed, setup.log)
    size = placed.select(F.max(F.octet_length("key") + F.octet_length("value"))).first()[0]
    job = setup.job()
    job.round_bytes = 5 * size
    assert len(setup.run(job)) == 60
    per_round = spark.read.option("basePath", job.path("rounds")).parquet(job.path("rounds/*/sent")).groupBy(F.input_file_name(), "partition").count()
    assert 5 <= max(r["count"] for r in per_round.collect()) <= 6


def test_lost_history_stops_delivery(setup):
    setup.append(30)
    job = setup.job()
    setup.run(job)
    shorter = setup.job()
    shorter.log_path = shared_dir(setup.spark, "log")
    changes.write_changes(log_rows(setup.spark, setup.identity, 5), shorter.log_path)
    with pytest.raises(HistoryLost, match=outcomes.OUT_OF_RANGE):
        shorter.start(available_now=True)
    assert [r.reason for r in shorter.blocked().collect()] == [outcomes.OUT_OF_RANGE]


def test_log_that_does_not_begin_at_zero(setup):
    changes.write_changes(log_rows(setup.spark, setup.identity, 30).filter("offset > 2"), setup.log)
    with pytest.raises(HistoryLost, match=outcomes.HISTORY_LOST):
        setup.job().start(available_now=True)


def test_pause_and_resume_lose_nothing(setup):
    setup.append(30)
    job = setup.job()
    query = start_delivery(job, every="1 second")
    done = threading.Event()
    for _ in range(120):
        if job.outcomes().filter("outcome is not null").count() == 30:
            break
        done.wait(0.5)
    query = apply_desired(query, job, "paused")
    assert query is None
    assert start_delivery(job, "paused") is None
    setup.append(60)
    assert job.outcomes().count() == 30
    got = setup.run(setup.job())
    assert set(got) == set(setup.expected(job)) and all(got.values())
    lines = [line for found in calls(setup.folder).values() for line in found]
    assert len(lines) == len(set(lines))


class Broken(io.BytesIO):
    def read(self, *_):
        raise http.client.IncompleteRead(b"")


def test_cut_connections_are_retries():
    for status in (200, 503):
        opener = Opener(status, b"")
        opener.make = Broken
        assert http_sender("http://example.invalid", "u", "p", opener=opener)("{}", {}) == (None, b"")
    opener = Opener(None, b"")
    opener.error = http.client.BadStatusLine("?")
    assert http_sender("http://example.invalid", "u", "p", opener=opener)("{}", {}) == (None, b"")


class Opener:
    """Stands in for the network."""

    def __init__(self, status, body):
        self.status, self.body, self.requests = status, body, []
        self.make, self.error = io.BytesIO, urllib.error.URLError("down")

    def open(self, request, timeout):
        self.requests.append((request, timeout))
        if self.status is None:
            raise self.error
        if self.status >= 300:
            raise urllib.error.HTTPError(request.full_url, self.status, "", Message(), self.make(self.body))
        return urllib.response.addinfourl(self.make(self.body), Message(), request.full_url, self.status)


def test_http_sender():
    opener = Opener(200, b"x" * 70_000)
    status, body = http_sender("http://example.invalid/in", "user", "secret", opener=opener)("{}", {"Idempotency-Key": "k"})
    assert (status, len(body)) == (200, (64 << 10) + 1)
    (request, timeout), = opener.requests
    assert (request.method, request.data, timeout) == ("POST", b"{}", 60.0)
    assert request.headers["Authorization"] == "Basic dXNlcjpzZWNyZXQ=" and request.headers["Idempotency-key"] == "k"
    assert http_sender("http://example.invalid", "u", "p", opener=Opener(302, b""))("{}", {}) == (302, b"")
    assert http_sender("http://example.invalid", "u", "p", opener=Opener(None, b""))("{}", {}) == (None, b"")


