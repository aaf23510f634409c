import hashlib

import pytest
from pyspark.sql import functions as F

from relaylog.functions.acks import classify_response, decode_ack
from relaylog.functions.filters import matches_filter
from relaylog.functions.keys import backoff_seconds, delivery_group, idempotency_key, parse_cursor, stable_event_id
from relaylog.model import Scope
from relaylog.operators import outcomes
from relaylog.operators.deliver import classify

ERROR = '{"result":{"error":{"policy":"%s","class":"late","description":"closed today"}}}'
OK = '{"result":{"success":{}}}'
ACKS = [
    (OK, "success"),
    (ERROR % "must_retry", "retry"),
    (ERROR % "keep_going", "keep_going"),
    ('{"result":{"success":null}}', None),
    ('{"result":{"success":[]}}', None),
    ('{"result":{"success":"{}"}}', None),
    ('{"result":{"error":{"policy":"keep_going"}}}', None),
    (ERROR % "surprise", None),
    ('{"result":{"success":{},"error":{"policy":"must_retry","class":"late","description":"closed today"}}}', "success"),
    ('{"result":{"success":1,"error":{"policy":"keep_going","class":"late","description":"closed today"}}}', "keep_going"),
    ('{"result":{}}', None),
    ("", None),
    ('{"result":[]}', None),
    ('{"result":null}', None),
    ("{}", None),
    ("{not json", None),
    (OK + " 7", None),
    (OK + "x", None),
    (" " + OK + "\n", "success"),
    ('{"RESULT":{"success":{"id":1}}}', "success"),
    ('{"result":{"Success":{}}}', None),
    ('{"result":{"error":{"Policy":"keep_going","CLASS":"late","Description":"closed today","since":3}}}', "keep_going"),
    ('{"result":{"error":{"policy":"keep_going","class":7,"description":"closed today"}}}', None),
    ('{"result":{"error":{"policy":"keep_going","class":null,"description":"closed today"}}}', None),
    ('{"result":{"error":{"policy":"keep_going","class":"","description":""}}}', "keep_going"),
    ('{"result":{"error":{"policy":"must_retry","policy":"keep_going","class":"late","description":"closed today"}}}', "keep_going"),
    ('{"result":{"success":{}},"result":{}}', None),
    ('{"result":{"success":{"a":NaN}}}', None),
    ('{"n":%s,"result":{"success":{}}}' % ("8" * 5000), "success"),
    ('{"n":%s.5e7,"result":{"success":{"m":-%s}}}' % ("3" * 4400, "2" * 4400), "success"),
    ('{"n":%s1%s,"result":{"success":{}}}' % ("[" * 900, "]" * 900), "success"),
    ('{"n":%s1%s,"result":{"success":{}}}' % ("[" * 1500, "]" * 1500), None),
    ('{"n":"%s","result":{"success":{}}}' % ("[{" * 1500), "success"),
    ("[" * 30_000, None),
    ('{"result":' * 12_000, None),
]


def test_acknowledgements(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(ACKS)], "i int, b string")
    got = [r.a for r in df.select("i", decode_ack(F.col("b")).alias("a")).orderBy("i").collect()]
    assert list(zip((b for b, _ in ACKS), got)) == ACKS


LIMIT = 64 << 10
RESPONSES = [
    (200, OK, "delivered", None),
    (200, ERROR % "keep_going", "skipped", None),
    (200, ERROR % "must_retry", None, "destination requested retry"),
    (200, "", None, "invalid acknowledgement"),
    (200, "{not json", None, "invalid acknowledgement"),
    (500, OK, None, "destination returned HTTP 500"),
    (401, '{"error":"bad token"}', None, "destination returned HTTP 401"),
    (199, OK, None, "destination returned HTTP 199"),
    (299, OK, "delivered", None),
    *[(s, OK, None, f"destination returned HTTP {s}") for s in (300, 301, 302, 303, 307, 308)],
    (200, OK.ljust(LIMIT), "delivered", None),
    (200, OK.ljust(LIMIT + 1), None, "destination response exceeds 64 KiB"),
    (200, OK.ljust(LIMIT) + "!", None, "destination response exceeds 64 KiB"),
    (500, OK.ljust(LIMIT + 1), None, "destination response exceeds 64 KiB"),
    (200, OK[:-1].ljust(LIMIT - 2, " ") + "é", None, "invalid acknowledgement"),
    (None, "", None, "destination unreachable"),
]


def test_responses(spark):
    rows = [(i, s, b) for i, (s, b, *_) in enumerate(RESPONSES)]
    df = spark.createDataFrame(rows, "i int, status int, body string")
    got = df.select("i", classify_response(F.col("status"), F.col("body")).alias("c")).orderBy("i").collect()
    assert [tuple(r.c) for r in got] == [(o, why) for _, _, o, why in RESPONSES]


def test_bytes_are_measured_as_they_came():
    body = b'{"note":"' + b"\xff" * 40_000 + b'","result":{"success":{}}}'
    assert classify(200, body) == ("delivered", None)
    assert classify(200, body.ljust(LIMIT)) == ("delivered", None)
    assert classify(200, body.ljust(LIMIT + 1))[1] == "destination response exceeds 64 KiB"


def test_the_sender_side_classifies_alike():
    for status, body, outcome, why in RESPONSES:
        assert classify(status, body) == (outcome, why)
    for body, ack in ACKS:
        want = {"success": "delivered", "keep_going": "skipped"}.get(ack)
        assert classify(200, body)[0] == want, body


@pytest.mark.parametrize(
    "payload, want",
    [
        ('{"event_name":"Created"}', True),
        ('{"event_name":"Deleted"}', False),
        ('{"event_name":"Deleted","event_name":"Created"}', True),
        ('{"other":1}', True),
        ('{"event_name":3}', True),
        ('{"event_name":null}', True),
        ('{"event_name":{"event_name":"Deleted"}}', True),
        ('"text"', True),
        ("[1,2,3]", True),
        ("null", True),
        ("{bad", True),
        ('{"event_name":"Deleted"} 7', True),
        ("", True),
    ],
)
def test_filters_fail_open(spark, payload, want):
    df = spark.createDataFrame([(payload,)], "p string")
    values = F.array(F.lit("Created"))
    no_values = F.lit(None).cast("array<string>")
    row = df.select(matches_filter(F.col("p"), "event_name", values), matches_filter(F.col("p"), "event_name", no_values)).first()
    assert tuple(row) == (want, True)


def test_backoff(spark):
    cases = [(0, 0.0, 1), (1, 0.0, 1), (2, 0.0, 2), (2, 1.0, 4), (5, 0.0, 16), (5, 1.0, 32), (6, 0.0, 32), (6, 1.0, 60), (40, 1.0, 60)]
    df = spark.createDataFrame(cases, "a int, u double, want int")
    assert df.filter(backoff_seconds(F.col("a"), F.col("u")) != F.col("want")).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([("e", "t", 2, 9), ("", "t", 2, 9)], "e string, t string, p int, o long")
    stable = stable_event_id(F.col("e"), F.col("t"), F.col("p"), F.col("o"))
    got = [tuple(r) for r in df.select(stable, idempotency_key(stable, F.lit("d"), F.lit(3))).collect()]
    digest = hashlib.sha256(b"t:2:9").hexdigest()
    assert got == [("e", "e:d:3"), (digest, f"{digest}:d:3")]
    assert delivery_group(Scope("n", "e", 2), "d") == "n.e.d.g2"


def test_cursors(spark):
    good = {"boot:0": ("boot", 0), "x:18446744073709551615": ("x", 2**64 - 1)}
    bad = ["broken", "x:no", "x:-1", "x:+1", "x:1:2", ":1", "x:", "", "x:18446744073709551616", "x:1\n"]
    df = spark.createDataFrame([(c,) for c in [*good, *bad]], "c string")
    got = {r.c: r.p and (r.p.boot, int(r.p.sequence)) for r in df.select("c", parse_cursor(F.col("c")).alias("p")).collect()}
    assert got == {**good, **dict.fromkeys(bad)}


KEY = "destination_id string, topic string, partition int, offset long"


def test_resolve_and_frontier(spark):
    rows = [
        ("d", "t", 0, 0, 0, None), ("d", "t", 0, 0, 1, "skipped"), ("d", "t", 0, 0, 2, "delivered"),
        ("d", "t", 0, 1, 0, None), ("d", "t", 0, 1, 1, None), ("d", "t", 0, 2, 0, "delivered"), ("d", "t", 1, 0, 0, "delivered"),
    ]
    attempts = spark.createDataFrame(rows, KEY + ", attempt int, outcome string")
    resolved = outcomes.resolve_attempts(attempts)
    got = {(r.partition, r.offset): (r.outcome, r.attempts_used) for r in resolved.collect()}
    assert got == {(0, 0): ("skipped", 2), (0, 1): (None, 2), (0, 2): ("delivered", 1), (1, 0): ("delivered", 1)}
    frontier = outcomes.commit_frontier(resolved)
    assert {r.partition: r.committed for r in frontier.collect()} == {0: 1, 1: 1}
    for rows_bound in (2, 10**9):
        left = outcomes.pending(resolved, frontier, rows_bound)
        assert sorted((r.partition, r.offset) for r in left.collect()) == [(0, 1), (0, 2)]


def test_retry_schedule(spark):
    attempts = spark.createDataFrame([("d", "t", 0, 5, a, 0.0) for a in range(8)], KEY + ", attempt int, u double")
    due = {r.attempt: r.due_seconds for r in outcomes.retry_schedule(attempts).collect()}
    assert [due[a] for a in range(8)] == [1, 2, 4, 8, 16, 32, 64, 96]
    chunked = {r.attempt: r.due_seconds for r in outcomes.retry_schedule(attempts, 2).collect()}
    assert chunked == due


def test_saving_skips_twice_changes_nothing(spark):
    rows = [("d", "s", f"e{o}", "t", 0, o, "skipped" if o % 2 else "delivered") for o in range(6)]
    done = spark.createDataFrame(rows, "destination_id string, source_id string, event_id string, topic string, partition int, offset long, outcome string")
    empty = done.select(*outcomes.SKIP_COLUMNS).limit(0)
    once = outcomes.save_skips(empty, done.unionByName(done))
    assert sorted(r.offset for r in once.collect()) == [1, 3, 5]
    assert outcomes.save_skips(once, done).count() == 3
    # The key is the position: another event id at the same place is not stored.
    assert outcomes.save_skips(once, done.withColumn("event_id", F.lit("other"))).count() == 3


def test_history(spark):
    # partition: first, end, committed, started -> state
    cases = {
        0: (0, 5, None, False, ("running", None, 0)),
        1: (0, 5, None, True, ("blocked", outcomes.HISTORY_LOST, None)),
        2: (3, 5, None, False, ("blocked", outcomes.HISTORY_LOST, None)),
        3: (0, 5, 5, True, ("running", None, 5)),
        4: (3, 5, 2, True, ("blocked", outcomes.OUT_OF_RANGE, None)),
        5: (0, 5, 6, True, ("blocked", outcomes.OUT_OF_RANGE, None)),
        6: (3, 5, 3, False, ("running", None, 3)),
    }
    bounds = spark.createDataFrame([("d", "t", p, c[0], c[1]) for p, c in cases.items()], "destination_id string, topic string, partition int, first_offset long, end_offset long")
    committed = spark.createDataFrame([("d", "t", p, c[2]) for p, c in cases.items() if c[2] is not None], "destination_id string, topic string, partition int, committed long")
    started = spark.createDataFrame([("d", "t", p) for p, c in cases.items() if c[3]], "destination_id string, topic string, partition int")
    got = {r.partition: (r.state, r.reason, r.baseline) for r in outcomes.check_history(bounds, committed, started).collect()}
    assert got == {p: c[4] for p, c in cases.items()}
    marked = outcomes.mark_started(started, bounds)
    assert marked.count() == 7 and outcomes.mark_started(marked, bounds).count() == 7


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "idempotency_key string, x int")
    assert outcomes.dedupe_deliveries(df).count() == 2
