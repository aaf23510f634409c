import hashlib
import json

import pytest
from pyspark.sql import functions as F

from relaylog.model import Column, Destination, Filter, Identity, Source
from relaylog.operators import decode, routing

DESTINATIONS = [
    Destination("all", "All", ("events", "orders")),
    Destination("one", "One", ("events",), Filter("event_name", ("Created",))),
    Destination("number", "Number", ("events",), Filter("score", ("1",))),
    Destination("missing", "Missing", ("events",), Filter("nowhere", ("1",))),
]
RECORD = (
    "source_id string, source_description string, topic string, partition int, offset long, event_id string, generation int, "
    "replay boolean, strings map<string,string>, payload string"
)


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("events", "Events", "t", 0, 0, "e0", 2, False, {"event_name": "Created"}, '{"n":1.50}'),
        ("events", "Events", "t", 0, 1, "", 2, False, {"event_name": "Deleted"}, '{"n":null}'),
        ("events", "Events", "t", 0, 2, "e2", 2, False, {}, "{}"),
        ("orders", "Orders", "o", 0, 0, "o0", 2, False, {}, "{}"),
        ("unknown", "Unknown", "u", 0, 0, "u0", 2, False, {}, "{}"),
    ]
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def subs(spark):
    return routing.subscriptions(routing.destinations_frame(spark, DESTINATIONS))


def places(df):
    return sorted((r.destination_id, r.topic, r.offset) for r in df.collect())


def test_route_and_filter(records, subs):
    routed = routing.apply_filters(routing.route(records, subs))
    assert places(routed) == [
        ("all", "o", 0), ("all", "t", 0), ("all", "t", 1), ("all", "t", 2),
        ("missing", "t", 0), ("missing", "t", 1), ("missing", "t", 2),
        ("number", "t", 0), ("number", "t", 1), ("number", "t", 2),
        ("one", "t", 0), ("one", "t", 1), ("one", "t", 2),
    ]
    assert places(routed.filter("outcome = 'filtered'")) == [("one", "t", 1)]


def test_paused_and_ready(spark, records, subs):
    desired = spark.createDataFrame([("all", "paused"), ("one", "running")], "destination_id string, desired string")
    assert {p[0] for p in places(routing.only_running(routing.route(records, subs), desired, 4))} == {"one"}
    states = spark.createDataFrame([("events", "running")], "source_id string, state string")
    got = {r.destination_id: (r.ready, r.reason) for r in routing.ready_destinations(subs, states).collect()}
    assert got["all"] == (False, "source unavailable: orders") and got["one"] == (True, None)
    none = routing.ready_destinations(subs, states.limit(0)).collect()
    assert {r.destination_id: r.reason for r in none}["all"] == "source unavailable: events"


def test_blocked_with_one_source_for_all_keeps_its_key(spark, records):
    blocked = spark.createDataFrame([("events",)], "source_id string")
    for name, left in (("events", 0), ("orders", 5)):
        kept = routing.drop_blocked(records.withColumn("source_id", F.lit(name)), blocked, 2)
        assert kept.columns == records.columns and kept.count() == left
        assert "NestedLoop" not in kept._jdf.queryExecution().executedPlan().toString()


def test_blocked(spark, records):
    blocked = spark.createDataFrame([("events", "why"), ("events", "again")], "source_id string, reason string")
    assert sorted(r.source_id for r in routing.drop_blocked(records, blocked, 2).collect()) == ["orders", "unknown"]


@pytest.mark.parametrize("partitions", [10, 10**9])
def test_known_skips_hold_only_for_historical_records(spark, records, subs, partitions):
    routed = routing.route(records, subs)
    skips = spark.createDataFrame(
        [("all", "t", 0, 0), ("all", "t", 0, 0), ("all", "t", 0, 2), ("one", "x", 0, 1)],
        "destination_id string, topic string, partition int, offset long",
    )
    horizons = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, horizon long")
    left = routing.drop_known_skips(routed, skips, horizons, partitions)
    assert set(places(routed)) - set(places(left)) == {("all", "t", 0)}
    assert left.count() == routed.count() - 1
    marked = routing.split_known_skips(routed, skips, horizons, partitions)
    assert places(marked.filter("known_skip")) == [("all", "t", 0)]


def test_requests(records, subs):
    sent = routing.headers(routing.envelopes(routing.route(records, subs))).filter("destination_id = 'one'").orderBy("offset")
    first, second, _ = sent.collect()
    assert first.body == (
        '{"data_source_id":"events","data_source_description":"Events","data_destination_id":"one",'
        '"data_destination_description":"One","payload":{"n":1.50}}'
    )
    digest = hashlib.sha256(b"t:0:1").hexdigest()
    assert second.headers == {
        "Content-Type": "application/json",
        "X-Relay-Event-ID": digest,
        "X-Relay-Delivery-Generation": "2",
        "X-Relay-Replay": "false",
        "X-Relay-Topic": "t",
        "X-Relay-Partition": "0",
        "X-Relay-Offset": "1",
        "Idempotency-Key": f"{digest}:one:2",
    }


def test_decode_to_request(spark):
    names = ("seq", "event_id", "shelf", "moved_at", "weight", "labels", "photo")
    types = ("int8", "text", "text", "timestamptz", "float8", "json", "bytea")
    source = Source("stock", "Stock moves", "moves", names, "seq", "shelf")
    identity = Identity("moves", "seq", "shelf", "event_id", 5, tuple(map(Column, names, types)))
    subs = routing.subscriptions(routing.destinations_frame(spark, [Destination("audit", "Audit trail", ("stock",))]))
    value = (
        '{"op":"%s","source":{"table":"moves","schema":"public"},"after":{"shelf":"B 12","seq":31337,"event_id":"mv/31337",'
        '"moved_at":"2016-03-01T00:10:00,25+01:00","weight":-4.40e1,"labels":"[\\"cold\\"]","photo":"cGl4"}}'
    )
    rows = [("moves-topic", 4, o, '{"shelf":"B 12"}', value % op) for o, op in enumerate("cr")]
    raw = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    sent = routing.headers(routing.envelopes(routing.route(decode.decode_changes(raw, source, identity, 7), subs))).collect()
    assert len(sent) == 2
    for row in sent:
        body = json.loads(row.body)
        assert (body["data_source_id"], body["data_source_description"]) == ("stock", "Stock moves")
        assert (body["data_destination_id"], body["data_destination_description"]) == ("audit", "Audit trail")
        assert body["payload"] == {
            "seq": 31337, "event_id": "mv/31337", "shelf": "B 12", "moved_at": "2016-02-29 23:10:00.25+00", "weight": -44.0,
            "labels": '["cold"]', "photo": "cGl4",
        }
        assert '"weight":-44' in row.body and row.headers["Idempotency-Key"] == "mv/31337:audit:7"


def test_filters_are_applied_before_bodies(records, subs):
    due = routing.envelopes(routing.apply_filters(routing.route(records, subs)).filter(F.col("outcome").isNull()))
    assert due.filter("destination_id = 'one'").count() == 2
