import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaylog.model import (
    Column,
    ConfigError,
    Destination,
    Filter,
    Identity,
    Scope,
    Source,
    check_application,
    is_integer,
    is_supported,
    name_prefix,
)
from relaylog.operators import contract

SOURCE = Source("orders", "Orders", "event_store", ("id", "correlation_id", "payload", "event_id"), "id", "correlation_id")


def table(spark, ids=(1, 2), correlation=("a", "b"), payload_type=None, drop=None, id_type=None):
    schema = T.StructType(
        [
            T.StructField("id", id_type or T.LongType()),
            T.StructField("correlation_id", T.StringType()),
            T.StructField("payload", T.StringType(), True, {"type": payload_type} if payload_type else None),
            T.StructField("event_id", T.StringType()),
        ]
    )
    df = spark.createDataFrame([(i, c, None, f"e{i}") for i, c in zip(ids, correlation)], schema)
    return df.drop(drop) if drop else df


def rules(df):
    return [r.rule for r in contract.check_contract(df, SOURCE).orderBy("rule_order").collect()]


def test_good_table(spark):
    assert rules(table(spark)) == []
    assert rules(table(spark, payload_type="json")) == []
    assert contract.identity_from(table(spark), SOURCE, 5) == Identity(
        "event_store", "id", "correlation_id", "event_id", 5,
        (Column("id", "int8"), Column("correlation_id", "text"), Column("payload", "text"), Column("event_id", "text")),
    )


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"drop": "payload"}, "missing columns"),
        ({"ids": (1, None)}, "serial null"),
        ({"ids": ("1", "2"), "id_type": T.StringType()}, "serial type"),
        ({"ids": (1, 1)}, "serial not unique"),
        ({"correlation": ("a", None)}, "partitioning null"),
        ({"payload_type": "jsonb"}, "unsupported type"),
        ({"payload_type": "uuid"}, "unsupported type"),
    ],
)
def test_broken_rules(spark, change, rule):
    assert rules(table(spark, **change)) == [rule]


def test_several_broken_rules_in_order(spark):
    found = rules(table(spark, ids=(1, 1, None), correlation=("a", None, "b"), payload_type="uuid", drop="event_id"))
    assert found == ["unsupported type", "missing columns", "serial null", "serial not unique", "partitioning null"]
    assert rules(table(spark, drop="id"))[:2] == ["missing columns", "serial missing"]
    assert [r.rule for r in contract.missing_table(spark, SOURCE).collect()] == ["missing table"]


def test_empty_table_is_fine(spark):
    assert rules(table(spark, ids=(), correlation=())) == []


def test_supported_types():
    assert is_supported("json") and not is_supported("uuid")
    assert is_integer("int2") and not is_integer("text")


def test_identity_json_round_trip():
    identity = Identity("t", "id", "k", "", 3, (Column("id", "int8"), Column("k", "text")))
    assert Identity.from_json(identity.to_json()) == identity


def sources(spark, rows):
    return spark.createDataFrame(rows, "namespace string, environment string, source_id string, generation long, `table` string")


def test_stream_names(spark):
    row = contract.stream_names(sources(spark, [("acme", "test", "orders", 1, "event_store")])).first()
    digest = hashlib.sha256(b'["acme","test","orders","1"]').digest()
    assert row.topic_prefix == "relay_g1_" + digest[:14].hex()
    assert row.topic == row.topic_prefix + ".public.event_store"
    assert (row.connector, row.slot, row.publication) == tuple(row.topic_prefix + s for s in ("_connector", "_slot", "_pub"))


def test_stream_names_do_not_collide(spark):
    rows = [
        ("ns", "dev", "orders.v1"), ("ns", "dev", "orders-v1"), ("ns", "dev", "orders_v1"), ("ns", "dev", "Orders_v1"),
        ("a.b", "c", "orders"), ("a", "b.c", "orders"), ("a", "bc", "d"), ("ab", "c", "d"), ("q\"<&>\u2028", "e", "é"),
    ]
    named = contract.stream_names(sources(spark, [(*r, g, "events") for r in rows for g in (1, 2)]))
    got = {(r.namespace, r.environment, r.source_id, r.generation): r.topic_prefix for r in named.collect()}
    assert len(set(got.values())) == 2 * len(rows)
    assert all(name_prefix(Scope(n, e, g), s) == prefix for (n, e, s, g), prefix in got.items())
    longest = contract.stream_names(sources(spark, [("n", "e", "s", 2**63 - 1, "t")])).first()
    assert len(longest.slot) <= 63


def test_schema_drift(spark):
    schema = "source_id string, pos int, name string, type string"
    old = spark.createDataFrame([("s", 0, "id", "int8"), ("s", 1, "a", "text"), ("s", 2, "b", "text")], schema)
    assert contract.schema_drift(old, old).count() == 0
    swapped = old.withColumn("pos", F.when(F.col("pos") == 0, 0).otherwise(3 - F.col("pos")))
    assert contract.schema_drift(old, swapped).count() == 2
    shorter = old.filter("pos < 2")
    assert [r.registered_name for r in contract.schema_drift(old, shorter).collect()] == ["b"]


def test_registration(spark):
    schema = "namespace string, environment string, generation long, source_id string, identity string, names string, topic_id string"
    old = spark.createDataFrame([("n", "e", 1, "s", "{}", "p", "1")], schema)
    new = spark.createDataFrame(
        [("n", "e", 1, "s", "{}", "p", "2"), ("n", "e", 2, "s", "{}", "p", "1"), ("n", "e", 1, "t", "{}", "p", "1")], schema
    )
    inserted, conflicts = contract.insert_registration(old, new)
    assert sorted((r.generation, r.source_id) for r in inserted.collect()) == [(1, "t"), (2, "s")]
    assert [r.topic_id for r in conflicts.collect()] == ["2"]
    again, none = contract.insert_registration(old, old)
    assert again.count() == 0 and none.count() == 0


def test_configuration_rules():
    good = Destination("d", "D", ("orders",), Filter("tenant", ("acme",)))
    check_application([SOURCE], [good])
    for bad in (
        lambda: check_application([SOURCE, SOURCE], []),
        lambda: check_application([], []),
        lambda: check_application([SOURCE], [good, good]),
        lambda: check_application([SOURCE], [Destination("d", "D", ("nope",))]),
        lambda: Destination("d", "D", ()),
        lambda: Destination("d", "", ("orders",)),
        lambda: Filter("tenant", ()),
        lambda: Filter("", ("x",)),
        lambda: Source("s", "S", "t", ("id",), "id", "key"),
        lambda: Source("", "S", "t", ("id",), "id", "id"),
        lambda: Scope("n", "e", 0),
    ):
        with pytest.raises(ConfigError):
            bad()


def test_a_table_that_does_not_exist(spark):
    source = Source("s", "S", "nowhere", ("id",), "id", "id")
    assert [(r.rule, r.column) for r in contract.check_contract(None, source).collect()] == [("missing table", "nowhere")]
