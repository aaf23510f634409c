"""The given tables seen as event tables, change logs, responses and control state.

Faults and responses follow from ids, so every branch of every operator has rows at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.functions.acks import MAX_RESPONSE_BYTES
from relaylog.functions.values import micros_from_ntz
from relaylog.model import Destination, Filter, Identity, Scope, Source, topic_name
from relaylog.operators import contract, decode, outcomes, routing
from relaylog.sources.changes import assign_positions, encode_changes

SCOPE = Scope("acme", "test", 1)
PARTITIONS = 10

EVENTS = Source(
    "app_events",
    "Application events",
    "app_events",
    ("id", "event_id", "aggregate_id", "correlation_id", "event_name", "recorded_on", "score", "payload"),
    "id",
    "correlation_id",
)
ORDERS = Source(
    "orders",
    "Order book",
    "orders",
    ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "o_orderkey",
    "o_custkey",
)
EVENTS_TOPIC = topic_name(SCOPE, EVENTS)
ORDERS_TOPIC = topic_name(SCOPE, ORDERS)

DESTINATIONS = [
    Destination("all_events", "Everything", ("app_events",)),
    Destination("sales", "Sales view", ("app_events",), Filter("event_name", ("purchase", "signup"))),
    Destination("numeric_filter", "Filter on a number", ("app_events",), Filter("score", ("1",))),
    Destination("paused_one", "Paused", ("app_events", "orders")),
    Destination("needs_both", "Both sources", ("app_events", "orders")),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("evt_"), F.col("event_id")).alias("event_id"),
        F.col("user_id").cast("string").alias("aggregate_id"),
        F.col("user_id").alias("correlation_id"),
        F.col("event_type").alias("event_name"),
        F.timestamp_micros(micros_from_ntz(F.col("ts"))).alias("recorded_on"),
        F.col("value").alias("score"),
        F.col("props").alias("payload"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def events_identity(spark: SparkSession, sf_dir: str) -> Identity:
    return contract.identity_from(app_events(spark, sf_dir), EVENTS, PARTITIONS)


def orders_identity(spark: SparkSession, sf_dir: str) -> Identity:
    return contract.identity_from(orders(spark, sf_dir), ORDERS, PARTITIONS)


def by_number(key: str) -> Column:
    """The tests' partition rule, the same in any SQL: key modulo the partition count."""
    return F.pmod(F.col(key), F.lit(PARTITIONS))


def positioned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = app_events(spark, sf_dir)
    return assign_positions(df, events_identity(spark, sf_dir), by_number("correlation_id"))


def positioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_positions(orders(spark, sf_dir), orders_identity(spark, sf_dir), by_number("o_custkey"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_changes(positioned_events(spark, sf_dir), EVENTS, events_identity(spark, sf_dir), EVENTS_TOPIC)


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_changes(positioned_orders(spark, sf_dir), ORDERS, orders_identity(spark, sf_dir), ORDERS_TOPIC, "r")


FAULT_CYCLE = 997
FAULTS = {"update": 13, "delete": 777, "table": 131, "key": 257, "float": 389, "event_id": 521, "trailing": 643}


def faulty_events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log with seven kinds of bad records in it."""

    def at(fault: str) -> Column:
        return F.col("id") % FAULT_CYCLE == FAULTS[fault]

    rows = positioned_events(spark, sf_dir).withColumn("event_id", F.when(at("event_id"), "").otherwise(F.col("event_id")))
    log = encode_changes(
        rows,
        EVENTS,
        events_identity(spark, sf_dir),
        EVENTS_TOPIC,
        F.when(at("update"), "u").when(at("delete"), "d").otherwise("c"),
    )
    # The serial and the key are read back from the record, as no other column is left here.
    serial = F.get_json_object("value", "$.after.id").cast("bigint")
    user = F.get_json_object("key", "$.correlation_id").cast("bigint")
    marked = log.withColumn("id", F.coalesce(serial, F.lit(FAULTS["delete"])))
    return marked.select(
        "topic",
        "partition",
        "offset",
        F.when(at("key"), F.to_json(F.struct((user + 1).alias("correlation_id")))).otherwise(F.col("key")).alias("key"),
        F.when(at("table"), F.replace("value", F.lit('"table":"app_events"'), F.lit('"table":"other"')))
        .when(at("float"), F.regexp_replace("value", r'"score":[^,}]+', '"score":1e999'))
        .when(at("trailing"), F.concat("value", F.lit(" 7")))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def decoded_events(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    log = faulty_events_log(spark, sf_dir) if faulty else events_log(spark, sf_dir)
    return decode.decode_changes(log, EVENTS, events_identity(spark, sf_dir), SCOPE.generation)


def decoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_changes(orders_log(spark, sf_dir), ORDERS, orders_identity(spark, sf_dir), SCOPE.generation)


def subscription_rows(spark: SparkSession) -> DataFrame:
    return routing.subscriptions(routing.destinations_frame(spark, DESTINATIONS))


def routed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources to all destinations, filters applied."""
    both = decoded_events(spark, sf_dir).drop("row").unionByName(decoded_orders(spark, sf_dir).drop("row"))
    return routing.apply_filters(routing.route(both, subscription_rows(spark)))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records straight from the table: position and identifiers, without encoding and decoding."""
    return positioned_events(spark, sf_dir).select(
        # A column, not a constant, so that the join with the subscriptions stays an equi-join.
        F.explode(F.array(F.lit(EVENTS.id))).alias("source_id"),
        F.lit(EVENTS.description).alias("source_description"),
        F.lit(EVENTS_TOPIC).alias("topic"),
        "partition",
        "offset",
        "id",
        "event_id",
        "aggregate_id",
        "event_name",
        F.lit(SCOPE.generation).alias("generation"),
        F.lit(False).alias("replay"),
        F.create_map(F.lit("event_name"), F.col("event_name")).alias("strings"),
    )


def event_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records routed to ``all_events`` and ``sales``, filters applied."""
    wanted = [d for d in DESTINATIONS if d.id in ("all_events", "sales")]
    subs = routing.subscriptions(routing.destinations_frame(spark, wanted))
    return routing.apply_filters(routing.route(event_records(spark, sf_dir), subs))


SUCCESS = '{"result":{"success":{}}}'
KEEP_GOING = '{"result":{"error":{"policy":"keep_going","class":"stale","description":"gone"}}}'


def _responses(serial: Column) -> Column:
    """Responses a destination gives to one record, in order."""

    def replies(*pairs) -> Column:
        return F.array(
            *[
                F.struct(F.lit(i).alias("attempt"), F.lit(status).alias("status"), (b if isinstance(b, Column) else F.lit(b)).alias("body"))
                for i, (status, b) in enumerate(pairs)
            ]
        )

    def padded(length: int) -> Column:
        return F.rpad(F.lit(SUCCESS), length, " ")

    return (
        F.when(serial % 101 == 50, replies((503, ""), (503, ""), (503, "")))
        .when(serial % 103 == 51, replies((200, padded(MAX_RESPONSE_BYTES))))
        .when(serial % 103 == 52, replies((200, padded(MAX_RESPONSE_BYTES + 1)), (200, SUCCESS)))
        .when(serial % 7 == 3, replies((503, ""), (200, SUCCESS)))
        .when(serial % 11 == 5, replies((200, KEEP_GOING)))
        .when(serial % 13 == 6, replies((200, '{"result":{}}'), (302, ""), (200, SUCCESS)))
        .otherwise(replies((200, SUCCESS)))
    )


def event_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt at the unfiltered event deliveries, with status and body."""
    sent = event_deliveries(spark, sf_dir).filter(F.col("outcome").isNull())
    exploded = sent.select(*outcomes.RECORD_KEY, "id", F.explode(_responses(F.col("id"))).alias("r"))
    return exploded.select(*outcomes.RECORD_KEY, "id", "r.attempt", "r.status", "r.body")


def event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event deliveries with their outcome: filtered, as resolved from the attempts, or null."""
    resolved = outcomes.resolve_attempts(outcomes.classify_responses(event_attempts(spark, sf_dir)))
    resolved = resolved.withColumnRenamed("outcome", "resolved")
    joined = event_deliveries(spark, sf_dir).join(resolved, outcomes.RECORD_KEY, "left")
    return joined.withColumn("outcome", F.coalesce("outcome", "resolved")).drop("resolved")
