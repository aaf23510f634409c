import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relaylog.model import RAW_RECORD, Column, ConfigError, Identity, Source
from relaylog.operators import decode

# A source of meter readings with a column of every type.
NAMES = ("reading", "meter", "pulses", "small", "mid", "litres", "rate", "estimated", "tags", "raw", "taken", "seen", "note")
TYPES = ("int8", "text", "int8", "int2", "int4", "float8", "float4", "bool", "json", "bytea", "timestamp", "timestamptz", "text")
SOURCE = Source("meters", "Meter readings", "readings", NAMES, "reading", "meter")
IDENTITY = Identity("readings", "reading", "meter", "", 3, [Column(n, t) for n, t in zip(NAMES, TYPES)])
WITH_EVENT_ID = (
    Source("meters", "Meter readings", "readings", (*NAMES, "event_id"), "reading", "meter"),
    Identity("readings", "reading", "meter", "event_id", 3, (*IDENTITY.columns, Column("event_id", "text"))),
)
META = '"source":{"connector":"any","schema":"public","table":"readings"}'
EMPTY = (
    '"reading":88,"meter":"m-4","pulses":null,"small":null,"mid":null,"litres":null,"rate":null,"estimated":null,'
    '"tags":"[]","raw":"","taken":null,"seen":null,"note":null'
)
VALID = f'{{"op":"c",{META},"after":{{{EMPTY}}}}}'
KEY = '{"meter":"m-4"}'


def run(spark, records, source=SOURCE, identity=IDENTITY, generation=1):
    raw = spark.createDataFrame([("t", 2, i, k, v) for i, (v, k) in enumerate(records)], RAW_RECORD)
    return decode.decode_changes(raw, source, identity, generation).orderBy("offset").collect()


def reason(spark, value, key=KEY, **kw):
    return run(spark, [(value, key)], **kw)[0].reject_reason


def test_full_record(spark):
    value = (
        '{"op":"r","ts_ms":5,"after":{"meter":"nord/7","reading":4503599627370497,"note":"Zähler \\u00e0 côté","unknown":[1],'
        '"litres":7.250e2,"rate":-1.5E-1,"pulses":-12,"small":-32768,"mid":2147483647,"estimated":false,'
        '"tags":"{\\"wet\\": [1, 2.50]}","raw":"cHVsc2U=","taken":951782400900000,"seen":"2019-12-31T22:45:10.0500-03:30"},' + META + "}"
    )
    (got,) = run(spark, [(value, '{"meter":"nord/7"}')], generation=4)
    assert got.reject_reason is None
    assert (got.source_id, got.topic, got.partition, got.offset, got.generation) == ("meters", "t", 2, 0, 4)
    assert (got.event_id, got.aggregate_id, got.event_name, got.replay) == ("", "", "", False)
    want = {
        "reading": 4503599627370497, "meter": "nord/7", "pulses": -12, "small": -32768, "mid": 2147483647, "litres": 725.0,
        "rate": -0.15, "estimated": False, "tags": '{"wet": [1, 2.50]}', "raw": "cHVsc2U=", "taken": "2000-02-29 00:00:00.9",
        "seen": "2020-01-01 02:15:10.05+00", "note": "Zähler à côté",
    }
    assert json.loads(got.payload) == want
    assert '"litres":725.0,' in got.payload.replace("}", ",") or '"litres":725,' in got.payload.replace("}", ",")
    assert got.row.litres == 725.0 and got.row.estimated is False and bytes(got.row.raw) == b"pulse"
    assert str(got.row.taken) == "2000-02-29 00:00:00.900000"


def test_nulls_and_event_id(spark):
    source, identity = WITH_EVENT_ID
    value = f'{{"after":{{{EMPTY},"event_id":"r/88"}},{META},"op":"r"}}'
    (got,) = run(spark, [(value, KEY)], source, identity, 2)
    assert (got.reject_reason, got.event_id, got.generation) == (None, "r/88", 2)
    assert json.loads(got.payload)["pulses"] is None and json.loads(got.payload)["event_id"] == "r/88"
    for bad, why in [
        ("null", 'event id column "event_id" is null'),
        ('""', 'event id column "event_id" is empty'),
        ("1", 'field "event_id" is not a string'),
    ]:
        value = f'{{"after":{{{EMPTY},"event_id":{bad}}},{META},"op":"c"}}'
        assert reason(spark, value, source=source, identity=identity) == f"payload: {why}"


def test_one_partition_and_last_duplicate_wins(spark):
    one = Identity("readings", "reading", "meter", "", 1, IDENTITY.columns)
    assert reason(spark, VALID, identity=one) is None
    twice = VALID.replace('"reading":88', '"reading":"none","reading":41').replace('"op":"c"', '"op":"d","op":"c"')
    (got,) = run(spark, [(twice, '{"meter":"m-9","meter":"m-4"}')])
    assert (got.reject_reason, got.row.reading) == (None, 41)


@pytest.mark.parametrize(
    "field, bad, why",
    [
        ("pulses", "12.5", "is not a valid int8"),
        ("small", "40000", "is not a valid int2"),
        ("mid", "true", "is not a valid int4"),
        ("litres", '"7"', "is not a valid float8"),
        ("rate", "1e60", "is not a valid float4"),
        ("estimated", '"yes"', "is not a valid bool"),
        ("tags", '"[1"', "is not valid JSON text"),
        ("raw", '"a?"', "is not valid base64"),
        ("raw", "{}", "is not a string"),
        ("note", "[]", "is not a string"),
        ("taken", '"today"', "is not valid timestamp microseconds"),
        ("seen", '"today"', "is not valid RFC3339"),
        ("seen", "false", "is not a string"),
    ],
)
def test_bad_values(spark, field, bad, why):
    old = {"tags": '"[]"', "raw": '""'}.get(field, "null")
    value = VALID.replace(f'"{field}":{old}', f'"{field}":{bad}')
    assert value != VALID
    assert reason(spark, value) == f'payload: field "{field}" {why}'


def but(old, new):
    assert old in VALID
    return VALID.replace(old, new)


# One fault or more in each; the first rule that is broken gives the reason.
REJECTS = [
    ("", KEY, "envelope is empty"),
    (None, "", "envelope is empty"),
    ('"c"', KEY, "envelope is not a JSON object"),
    (VALID[:-2], KEY, "envelope is not a JSON object"),
    (VALID + VALID, KEY, "envelope is not a JSON object"),
    (VALID + ",", KEY, "envelope is not a JSON object"),
    (but('"op":"c",', ""), KEY, 'envelope is missing "op"'),
    (but('"op":"c"', '"op":{}'), KEY, 'field "envelope.op" is not a string'),
    (but('"op":"c"', '"op":null'), KEY, "unsupported operation"),
    (but('"op":"c"', '"op":"u"'), KEY, "unsupported operation"),
    (but('"op":"c"', '"op":"d"'), "", "unsupported operation"),
    (but('"op":"c"', '"op":"t"'), KEY, "unsupported operation"),
    (but('"op":"c"', '"op":"C"'), KEY, "unsupported operation"),
    (but(META + ",", ""), KEY, "envelope is missing source metadata"),
    (but(META, '"source":"readings"'), KEY, "source metadata is not a JSON object"),
    (but(META, '"source":null'), KEY, "source metadata is not a JSON object"),
    (but('"schema":"public",', ""), KEY, 'source metadata is missing "schema"'),
    (but('"schema":"public"', '"schema":false'), KEY, 'field "source metadata.schema" is not a string'),
    (but(',"table":"readings"', ""), KEY, 'source metadata is missing "table"'),
    (but('"table":"readings"', '"table":[]'), KEY, 'field "source metadata.table" is not a string'),
    (but('"public"', '"archive"'), KEY, "source schema is not public"),
    (but('"table":"readings"', '"table":"Readings"'), KEY, "source table does not match configured table"),
    (f'{{"op":"r",{META}}}', KEY, "operation has no after object"),
    (f'{{"after":null,"op":"r",{META}}}', "[]", "operation has no after object"),
    (f'{{"after":"row","op":"r",{META}}}', KEY, "after is not a JSON object"),
    (VALID, "", "Kafka key is empty"),
    (VALID, None, "Kafka key is empty"),
    (VALID, '["m-4"]', "Kafka key is not a JSON object"),
    (VALID, '{"meter":"m-4","reading":88}', "Kafka key must contain only the partition column"),
    (VALID, "{ }", "Kafka key must contain only the partition column"),
    (VALID, '{"Meter":"m-4"}', "Kafka key is missing the partition column"),
    (VALID, '{"meter":null}', "Kafka key is missing the partition column"),
    (but('"meter":"m-4"', '"meter":null'), KEY, "after object has a null partition column"),
    (VALID, '{"meter":4}', 'field "meter in Kafka key" is not a string'),
    (VALID, '{"meter":"m-04"}', "Kafka key does not match the partition column"),
    (but('"reading":88,', ""), KEY, 'after object is missing configured column "reading"'),
    (but('"reading":88', '"reading":null'), KEY, 'required column "reading" is null'),
    (but(',"note":null', ""), KEY, 'after object is missing configured column "note"'),
]


def test_rejects(spark):
    got = run(spark, [(v, k) for v, k, _ in REJECTS])
    assert [r.reject_reason for r in got] == [f"payload: {why}" for _, _, why in REJECTS]
    assert all(r.payload is None and r.row is None for r in got)


@pytest.mark.parametrize(
    "identity, generation",
    [
        (IDENTITY, 0),
        (Identity("readings", "reading", "meter", "", 0, IDENTITY.columns), 1),
        (Identity("readings", "reading", "meter", "", 3, IDENTITY.columns[:-1]), 1),
        (Identity("gauges", "reading", "meter", "", 3, IDENTITY.columns), 1),
        (Identity("readings", "reading", "meter", "nope", 3, IDENTITY.columns), 1),
    ],
)
def test_invalid_identity(spark, identity, generation):
    with pytest.raises(ConfigError):
        run(spark, [(VALID, KEY)], identity=identity, generation=generation)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(max_size=60) | st.sampled_from([VALID, VALID[:-1], VALID * 2]), st.text(max_size=20)), max_size=40))
def test_never_fails_and_keeps_every_row(spark, records):
    records = [(v.encode("utf-8", "replace").decode(), k.encode("utf-8", "replace").decode()) for v, k in records]
    got = run(spark, [*records, (VALID, KEY)])
    assert len(got) == len(records) + 1
    assert got[-1].reject_reason is None


def decoded_frame(spark):
    rows = [("s", "t", p, o, "bad" if (p, o) in {(0, 3), (0, 5), (2, 0)} else None) for p in range(4) for o in range(6)]
    return spark.createDataFrame(rows, "source_id string, topic string, partition int, offset bigint, reject_reason string")


@pytest.mark.parametrize("partitions", [4, 10**9])
def test_accepted_prefix(spark, partitions):
    got = decode.accepted_prefix(decoded_frame(spark), partitions)
    kept = {(r.partition, r.offset) for r in got.collect()}
    assert kept == {(0, 0), (0, 1), (0, 2)} | {(p, o) for p in (1, 3) for o in range(6)}


def test_blocked_sources(spark):
    got = decode.blocked_sources(decoded_frame(spark).withColumn("reject_reason", F.col("reject_reason"))).collect()
    assert [tuple(r) for r in got] == [("s", "bad", "t", 0, 3)]
