"""One query per operator, each over whole tables. ``plans.oracle`` holds the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.functions import filters, keys
from relaylog.functions import jsontext as J
from relaylog.functions import values as V
from relaylog.model import Source
from relaylog.operators import activity, contract, decode, outcomes, routing, tables
from relaylog.operators.deliver import deliver
from relaylog.operators.scale import small_side
from relaylog.plans import event_table as E
from relaylog.session import shared_dir
from relaylog.sources import changes, segments
from relaylog.sources.activity_log import ActivityLog
from relaylog.sources.tables import snapshot_scan
from relaylog.streaming.delivery import CapturedSource, DeliveryJob, HistoryLost, start_delivery
from relaylog.streaming.replay import ReplayJob, replay_records

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- scans, log, sinks ---------------------------------------------------------------------------


@query
def snapshot_scan_events(spark, sf):
    rows = snapshot_scan(E.app_events(spark, sf), E.EVENTS)
    return rows.withColumn("recorded_on", F.unix_micros("recorded_on"))


@query
def snapshot_scan_orders(spark, sf):
    return snapshot_scan(E.orders(spark, sf), E.ORDERS).drop("o_orderdate")


@query
def assign_positions(spark, sf):
    return E.positioned_events(spark, sf).select("id", "partition", "offset")


@query
def log_bounds(spark, sf):
    return changes.log_bounds(E.events_log(spark, sf).unionByName(E.orders_log(spark, sf)))


@query
def encode_changes(spark, sf):
    """The records as written, read back member by member."""
    after = F.from_json(
        F.get_json_object("value", "$.after"),
        "id bigint, event_id string, event_name string, recorded_on string, score double, payload string",
    )
    return E.events_log(spark, sf).select(
        "topic",
        "partition",
        "offset",
        "key",
        F.get_json_object("value", "$.op").alias("op"),
        F.get_json_object("value", "$.source.schema").alias("source_schema"),
        F.get_json_object("value", "$.source.table").alias("source_table"),
        after.alias("after"),
    ).select("*", "after.*").drop("after")


@query
def log_round_trip(spark, sf):
    """Written by topic and partition and read back as a batch."""
    path = shared_dir(spark, "log")
    changes.write_changes(E.events_log(spark, sf), path)
    back = changes.read_changes(spark, path)
    return back.select("topic", "partition", "offset", "key", F.get_json_object("value", "$.after.event_id").alias("event_id"))


@query
def follow_log(spark, sf):
    """The written log followed as a stream, decoded on the way."""
    path, out, checkpoint = (shared_dir(spark, n) for n in ("log", "decoded", "checkpoint"))
    changes.write_changes(E.faulty_events_log(spark, sf), path)
    stream = changes.read_changes_stream(spark, path, per_trigger=4)
    decoded = decode.decode_changes(stream, E.EVENTS, E.events_identity(spark, sf), E.SCOPE.generation)
    rows = decoded.select("partition", "offset", "event_name", "reject_reason")
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.format("parquet").start(out).awaitTermination()
    back = spark.read.schema(rows.schema).parquet(out)
    return back.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def _append_events(spark, sf, log, rows) -> int:
    return segments.append_rows(rows, E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC, log, E.by_number("correlation_id"))


@query
def live_append(spark, sf):
    """Half the events as a snapshot, more of them later, then late commits with smaller serials; all of it once more adds nothing."""
    log, rows, last = shared_dir(spark, "log"), E.app_events(spark, sf), F.col("id") % 10
    for visible in (last < 5, (last < 5) | (last >= 7), F.lit(True)):
        _append_events(spark, sf, log, rows.filter(visible))
    again = _append_events(spark, sf, log, rows)
    after = [F.get_json_object("value", f"$.after.{c}").alias(c) for c in ("id", "event_id", "event_name")]
    op = F.get_json_object("value", "$.op").alias("op")
    found = changes.read_changes(spark, log).select("topic", "partition", "offset", op, *after, F.lit(again).cast("long").alias("again"))
    return found.withColumn("id", F.col("id").cast("long"))


def _segmented_log(spark, sf) -> str:
    """Events in segments with a manifest, orders as files that the manifest does not have."""
    log = shared_dir(spark, "log")
    segments.write_segment(E.events_log(spark, sf), log, 64)
    segments.index_log(spark, log)
    changes.write_changes(E.orders_log(spark, sf), log)
    return log


@query
def manifest_bounds(spark, sf):
    """Bounds, records and files of each log partition by the manifest; what it lacks is scanned."""
    log = _segmented_log(spark, sf)
    entries = segments.manifest(spark, log)
    records = entries.groupBy("topic", "partition").agg(F.sum("records").alias("records"))
    return segments.log_bounds(spark, log, entries).join(records, ["topic", "partition"])


@query
def range_read(spark, sf):
    """The middle half of every log partition, from the files that hold it."""
    log = _segmented_log(spark, sf)
    bounds = segments.log_bounds(spark, log).collect()  # one row per log partition
    ranges = [(b["topic"], b["partition"], b["end_offset"] // 4, b["end_offset"] * 3 // 4) for b in bounds]
    return segments.read_range(spark, log, ranges).select("topic", "partition", "offset", "key")


ROUND_BYTES = 2_000


@query
def byte_bounded_round(spark, sf):
    """The first round of every log partition when a round is bounded by bytes: here those of the payload member."""
    size = F.octet_length(F.get_json_object("value", "$.after.payload"))
    cut = segments.within_bytes(E.events_log(spark, sf), ROUND_BYTES, size)
    return cut.groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"), F.sum(size).alias("bytes"), (F.max("offset") + 1).alias("next_offset")
    )


# --- contract ------------------------------------------------------------------------------------

LINEITEM = Source("lineitem", "Order lines", "lineitem", ("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", "l_partkey")
NATION = Source("nation", "Nations", "nation", ("n_name", "n_regionkey"), "n_name", "n_regionkey")
EMBEDDINGS = Source("embeddings", "Vectors", "embeddings", ("vec_id", "embedding", "label"), "vec_id", "label")
PART = Source("part", "Parts", "part", ("p_partkey", "p_missing", "p_brand"), "p_partkey", "p_brand")
NULL_USERS = Source("null_users", "Events with null users", "events", ("event_id", "user_id"), "event_id", "user_id")


def _contract_cases(spark, sf):
    with_nulls = E.table(spark, sf, "events").withColumn("user_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")))
    return [
        (E.app_events(spark, sf), E.EVENTS),
        (E.table(spark, sf, "lineitem"), LINEITEM),
        (E.table(spark, sf, "nation"), NATION),
        (E.table(spark, sf, "embeddings"), EMBEDDINGS),
        (E.table(spark, sf, "part"), PART),
        (with_nulls, NULL_USERS),
    ]


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f)
    return first


@query
def table_facts(spark, sf):
    return _union(
        [contract.table_facts(df, s).withColumn("source_id", F.lit(s.id)) for df, s in _contract_cases(spark, sf)]
    )


@query
def contract_violations(spark, sf):
    return _union(
        [contract.check_contract(df, s).withColumn("source_id", F.lit(s.id)) for df, s in _contract_cases(spark, sf)]
    )


def _columns_of(df: DataFrame, columns: list[tuple[Column, Column]]) -> DataFrame:
    rows = F.array(*[F.struct(n.alias("name"), t.alias("type")) for n, t in columns])
    return df.select(F.col("p_partkey").alias("source_id"), F.posexplode(rows).alias("pos", "c")).select("source_id", "pos", "c.*")


@query
def schema_drift(spark, sf):
    """Every part as a source whose current columns may differ in type, name, or number."""
    part = E.table(spark, sf, "part")
    size = F.col("p_size")
    registered = _columns_of(
        part, [(F.lit("id"), F.lit("int8")), (F.col("p_brand"), F.lit("text")), (F.lit("size"), F.lit("int4"))]
    )
    current = _columns_of(
        part,
        [
            (F.lit("id"), F.lit("int8")),
            (F.col("p_brand"), F.when(size > 25, "json").otherwise("text")),
            (F.lit("size"), F.lit("int4")),
            (F.lit("price"), F.lit("float8")),
        ],
    ).filter((F.col("pos") < 3) | (F.col("source_id") % 3 == 0))
    return contract.schema_drift(registered, current)


@query
def identity_drift(spark, sf):
    """Every customer as a registered source; some have other partitions, another key or another table now, or are gone."""
    customer, key = E.table(spark, sf, "customer"), F.col("c_custkey")

    def sources(changed: bool) -> DataFrame:
        def now(condition: Column, other: str, usual: str) -> Column:
            return F.when(condition & F.lit(changed), other).otherwise(usual)

        values = {
            "table": now(key % 7 == 1, "orders_v2", "orders"),
            "serial_column": F.lit("o_orderkey"),
            "partitioning_column": now(key % 11 == 2, "o_clerk", "o_custkey"),
            "event_id_column": now(key % 13 == 3, "event_id", ""),
            "partitions": now(F.col("c_acctbal") < 0, "20", "10").cast("int"),
            **{f: F.concat(F.lit(f"{f}_"), now(key % 17 == 4, "x", "a")) for f in contract.NAME_FIELDS},
        }
        return customer.select(F.col("c_name").alias("source_id"), *[v.alias(k) for k, v in values.items()], "c_custkey")

    return contract.identity_drift(sources(False), sources(True).filter(key % 19 != 5))


def _customer_sources(spark, sf) -> DataFrame:
    return E.table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("namespace"),
        F.lit("R&D <a>").alias("environment"),
        F.col("c_name").alias("source_id"),
        (F.col("c_nationkey") + 1).cast("long").alias("generation"),
        F.lit("orders").alias("table"),
        "c_acctbal",
    )


@query
def stream_names(spark, sf):
    return contract.stream_names(_customer_sources(spark, sf).drop("c_acctbal"))


@query
def insert_registration(spark, sf):
    """Customers in debt are new; for the rich the identity has changed since registration."""
    names = contract.stream_names(_customer_sources(spark, sf))
    registrations = names.select(
        *contract.REGISTRATION_KEY,
        F.lit('{"partitions": 10}').alias("identity"),
        F.col("topic_prefix").alias("names"),
        F.col("source_id").alias("topic_id"),
        "c_acctbal",
    )
    existing = registrations.filter(F.col("c_acctbal") >= 0).drop("c_acctbal")
    changed = F.when(F.col("c_acctbal") > 5000, '{"partitions": 20}').otherwise(F.col("identity"))
    new = registrations.withColumn("identity", changed).drop("c_acctbal")
    inserted, conflicts = contract.insert_registration(existing, new)
    return inserted.withColumn("result", F.lit("inserted")).unionByName(conflicts.withColumn("result", F.lit("conflict")))


# --- decode --------------------------------------------------------------------------------------


@query
def decode_accepted(spark, sf):
    decoded = E.decoded_events(spark, sf, faulty=True).filter(F.col("reject_reason").isNull())
    return decoded.select(
        "topic",
        "partition",
        "offset",
        "event_id",
        "aggregate_id",
        "event_name",
        "generation",
        F.col("row.id").alias("id"),
        F.col("row.correlation_id").alias("correlation_id"),
        F.unix_micros("row.recorded_on").alias("recorded_micros"),
        F.col("row.score").alias("score"),
        F.col("row.payload").alias("payload"),
    )


@query
def decode_payload(spark, sf):
    """The wire payload read back member by member."""
    members = "id bigint, event_id string, correlation_id bigint, event_name string, recorded_on string, score double, payload string"
    decoded = E.decoded_events(spark, sf)
    return decoded.select("partition", "offset", F.from_json("payload", members).alias("p")).select("partition", "offset", "p.*")


@query
def decode_rejects(spark, sf):
    decoded = E.decoded_events(spark, sf, faulty=True).filter(F.col("reject_reason").isNotNull())
    return decoded.select("partition", "offset", "reject_reason")


@query
def decode_orders(spark, sf):
    decoded = E.decoded_orders(spark, sf)
    return decoded.select(
        "partition", "offset", "reject_reason", "row.o_orderkey", "row.o_custkey", "row.o_orderstatus", "row.o_totalprice",
        F.col("row.o_orderdate").cast("string").alias("o_orderdate"),
    )


@query
def accepted_prefix(spark, sf):
    # Decoded once, as the delivery job does: the prefix needs it twice.
    path = shared_dir(spark, "decoded")
    E.decoded_events(spark, sf, faulty=True).select("topic", "partition", "offset", "event_id", "reject_reason").write.parquet(path)
    return decode.accepted_prefix(spark.read.parquet(path), E.PARTITIONS).select("partition", "offset", "event_id")


@query
def blocked_sources(spark, sf):
    return decode.blocked_sources(E.decoded_events(spark, sf, faulty=True))


# --- values --------------------------------------------------------------------------------------


def _member_of(df: DataFrame, json_value: Column, *keep: str) -> DataFrame:
    """Rows with ``v``: a JSON value as the marked member of a parsed record."""
    text = F.concat(F.lit('{"v":'), json_value, F.lit("}"))
    parsed = df.select(*keep, J.parse_single_object(J.mark_scalars(text), ["v"]).alias("parsed"))
    return parsed.select(*keep, J.member(J.single_object(F.col("parsed")), "v").alias("v"))


@query
def wire_ints(spark, sf):
    number = F.col("l_partkey") * 37 * F.pow(F.lit(10), F.col("l_linenumber")).cast("long")
    df = _member_of(E.table(spark, sf, "lineitem"), number.cast("string"), "l_orderkey", "l_linenumber", "l_partkey")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[V.wire_value(t, F.col("v")).alias(t) for t in ("int2", "int4", "int8")]
    )


@query
def wire_floats(spark, sf):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    df = _member_of(E.table(spark, sf, "lineitem"), F.concat(cents, F.lit("e-2")), "l_orderkey", "l_linenumber", "l_extendedprice")
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice", V.wire_value("float8", F.col("v")).alias("wire"))


@query
def wire_small_floats(spark, sf):
    """Discounts as float4, some of them out of range or no numbers."""
    key = F.col("l_orderkey")
    cents = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    text = F.when(key % 5 == 1, "1e39").when(key % 5 == 2, F.concat(F.lit('"'), cents, F.lit('"'))).otherwise(F.concat(cents, F.lit("E-2")))
    df = _member_of(E.table(spark, sf, "lineitem"), text, "l_orderkey", "l_linenumber", "l_discount")
    return df.select("l_orderkey", "l_linenumber", V.wire_value("float4", F.col("v")).alias("wire"))


@query
def wire_bools(spark, sf):
    """Flags from event types: JSON booleans, and values that are none."""
    kind = F.col("event_type")
    text = F.when(kind == "click", "true").when(kind == "view", "false").when(kind == "error", "null").when(kind == "signup", "1").otherwise('"true"')
    df = _member_of(E.table(spark, sf, "events"), text, "event_id", "event_type")
    return df.select("event_id", "event_type", V.wire_value("bool", F.col("v")).alias("wire"))


@query
def expand_decimal(spark, sf):
    lit = F.concat(
        F.lit("-"),
        F.col("l_quantity").cast("int").cast("string"),
        F.lit("."),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        F.lit("e"),
        (F.col("l_partkey") % 9 - 4).cast("string"),
    )
    literals = E.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", lit.alias("literal"))
    return literals.withColumn("expanded", V.expand_decimal(F.col("literal")))


@query
def wire_timestamps(spark, sf):
    events = E.table(spark, sf, "events")
    micros = V.micros_from_ntz(F.col("ts"))
    plain = _member_of(events, micros.cast("string"), "event_id", "ts")
    plain = plain.select("event_id", "ts", V.wire_value("timestamp", F.col("v")).alias("wire_ntz"))
    local = F.replace(V.format_sql_timestamp(F.col("ts")), F.lit(" "), F.lit("T"))
    zoned = _member_of(plain, F.concat(F.lit('"'), local, F.lit('+05:30"')), "event_id", "wire_ntz")
    return zoned.select("event_id", "wire_ntz", V.wire_value("timestamptz", F.col("v")).alias("wire_tz"))


@query
def wire_binary(spark, sf):
    """Padded, raw and broken base64 by part size."""
    encoded = F.base64(F.col("p_name"))
    text = (
        F.when(F.col("p_size") < 10, F.concat(encoded, F.lit("!")))
        .when(F.col("p_size") < 25, F.rtrim(encoded, F.lit("=")))
        .otherwise(encoded)
    )
    df = _member_of(E.table(spark, sf, "part"), F.concat(F.lit('"'), text, F.lit('"')), "p_partkey")
    wire = V.wire_value("bytea", F.col("v"))
    return df.select("p_partkey", wire.alias("wire"), V.typed_value("bytea", wire).cast("string").alias("decoded"))


@query
def json_text(spark, sf):
    """Is the column text valid JSON? Broken for errors and views."""
    text = (
        F.when(F.col("event_type") == "error", F.concat("props", F.lit(" 7")))
        .when(F.col("event_type") == "view", F.replace("props", F.lit("}"), F.lit("")))
        .otherwise(F.col("props"))
    )
    df = E.table(spark, sf, "events").select("event_id", text.alias("text"))
    df = _member_of(df, F.expr("substr(to_json(array(text)), 2, length(to_json(array(text))) - 2)"), "event_id")
    return df.select("event_id", V.wire_value("json", F.col("v")).alias("wire"))


@query
def raw_members(spark, sf):
    text = F.replace("props", F.lit("}"), F.lit(', "e": 1.50e3, "s": "5", "n": null}'))
    df = E.table(spark, sf, "events").select("event_id", F.explode(J.raw_members(text)).alias("name", "m"))
    return df.select("event_id", "name", F.col("m.kind").alias("kind"), F.col("m.text").alias("text"))


@query
def single_object(spark, sf):
    """Whole document texts, and the same wrapped as one JSON object, with and without trailing data."""
    docs = E.table(spark, sf, "documents").select("doc_id", "lang", "text")
    wrapped = F.to_json(F.struct("text"))
    tried = F.when(F.col("doc_id") % 3 == 0, F.concat(wrapped, F.lit(" 7"))).otherwise(wrapped)
    return docs.select(
        "doc_id",
        J.is_single_object(F.col("text")).alias("bare"),
        J.is_single_object(tried).alias("wrapped"),
        F.length(J.raw_members(tried)["text"]["text"]).cast("long").alias("chars"),
    )


# --- keys, filters -------------------------------------------------------------------------------


@query
def event_keys(spark, sf):
    records = E.event_records(spark, sf)
    event_id = F.when(F.col("event_name") == "error", "").otherwise(F.col("event_id"))
    stable = keys.stable_event_id(event_id, F.col("topic"), F.col("partition"), F.col("offset"))
    return records.select(
        "id",
        stable.alias("stable_id"),
        keys.idempotency_key(stable, F.lit("projection"), F.col("generation")).alias("idempotency_key"),
        F.lit(keys.delivery_group(E.SCOPE, "projection")).alias("delivery_group"),
    )


@query
def backoff_bounds(spark, sf):
    attempt = (F.col("o_orderkey") % 12).cast("int")
    return E.orders(spark, sf).select(
        "o_orderkey",
        attempt.alias("attempt"),
        keys.backoff_seconds(attempt, F.lit(0.0)).alias("shortest"),
        keys.backoff_seconds(attempt, F.lit(1.0)).alias("longest"),
    )


@query
def cursor_parse(spark, sf):
    """Good cursors, and broken ones by turn: no boot, no colon, two colons, a sign."""
    turn = F.col("turn").cast("string")
    good = keys.cursor_for(F.col("role"), F.col("turn"))
    cursor = (
        F.when(F.col("turn") % 7 == 1, F.concat(F.lit(":"), turn))
        .when(F.col("turn") % 7 == 2, F.concat(F.col("role"), turn))
        .when(F.col("turn") % 7 == 3, F.concat(good, F.lit(":"), turn))
        .when(F.col("turn") % 7 == 4, F.concat(F.col("role"), F.lit(":-"), turn))
        .otherwise(good)
    )
    parsed = keys.parse_cursor(cursor)
    return E.table(spark, sf, "conversations").select(
        "conv_id", "turn", cursor.alias("cursor"), parsed["boot"].alias("boot"), parsed["sequence"].cast("long").alias("sequence")
    )


@query
def matches_filter(spark, sf):
    """Filters on JSON text: a string column, a number column, a missing column, broken text."""
    payload = F.to_json(F.struct("event_type", "value"))
    broken = F.when(F.col("event_id") % 10 == 0, F.concat(payload, F.lit("x"))).otherwise(payload)
    wanted = F.array(F.lit("purchase"), F.lit("signup"))
    return E.table(spark, sf, "events").select(
        "event_id",
        filters.matches_filter(broken, "event_type", wanted).alias("by_type"),
        filters.matches_filter(payload, "value", wanted).alias("by_number"),
        filters.matches_filter(payload, "nowhere", wanted).alias("by_missing"),
    )


# --- routing -------------------------------------------------------------------------------------


@query
def route_fanout(spark, sf):
    return (
        E.routed_records(spark, sf)
        .groupBy("destination_id", "source_id", "partition")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("offset").alias("offsets"))
    )


@query
def route_filtered(spark, sf):
    """How many records are due and how many are filtered, per destination and log partition."""
    return (
        E.routed_records(spark, sf)
        .groupBy("destination_id", "partition", F.coalesce("outcome", F.lit("due")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _desired(spark, sf) -> DataFrame:
    """Desired states from a command log: every order is a command to one of the destinations."""
    n = len(E.DESTINATIONS)
    ids = F.array(*[F.lit(d.id) for d in E.DESTINATIONS])
    commands = E.orders(spark, sf).select(
        F.get(ids, (F.col("o_orderkey") % n).cast("int")).alias("destination_id"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderkey") % n == 3, "paused").otherwise("running").alias("state"),
    )
    stored = routing.destinations_frame(spark, E.DESTINATIONS).select(
        "destination_id", F.lit("running").alias("desired"), F.lit(1).cast("long").alias("revision")
    )
    return tables.fold_desired(stored, commands, ["destination_id"])


@query
def route_running(spark, sf):
    routed = E.event_deliveries(spark, sf).drop("outcome")
    paused = routing.route(E.event_records(spark, sf), E.subscription_rows(spark).filter("destination_id = 'paused_one'"))
    both = routed.unionByName(paused)
    return routing.only_running(both, _desired(spark, sf), len(E.DESTINATIONS)).select("destination_id", "partition", "offset")


def _source_blocks(spark, sf) -> DataFrame:
    """Orders are blocked by the last urgent order, events never."""
    urgent = F.when(F.col("o_orderpriority").startswith("1"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")))
    of_orders = E.orders(spark, sf).select(
        F.lit("orders").alias("source_id"), F.col("o_orderkey").alias("seq"), F.coalesce(urgent, F.lit("")).alias("reason")
    )
    of_events = E.table(spark, sf, "events").select(
        F.lit("app_events").alias("source_id"), F.col("event_id").alias("seq"), F.lit(" ").alias("reason")
    )
    return tables.latch_blocks(of_orders.unionByName(of_events))


@query
def ready_destinations(spark, sf):
    blocked = _source_blocks(spark, sf).select("source_id", F.lit("blocked").alias("state"))
    subs = E.subscription_rows(spark)
    known = subs.select("source_id").distinct()
    states = known.join(blocked, "source_id", "left").select("source_id", F.coalesce("state", F.lit("running")).alias("state"))
    return routing.ready_destinations(subs, states)


@query
def drop_blocked(spark, sf):
    both = E.event_records(spark, sf).select("source_id", "topic", "partition", "offset").unionByName(
        E.positioned_orders(spark, sf).select(F.lit("orders").alias("source_id"), F.lit(E.ORDERS_TOPIC).alias("topic"), "partition", "offset")
    )
    return routing.drop_blocked(both, _source_blocks(spark, sf), 2)


def _horizons(spark, sf) -> DataFrame:
    """Half of each log partition was there at start."""
    bounds = changes.log_bounds(E.event_records(spark, sf))
    return bounds.select("topic", "partition", F.floor(F.col("end_offset") / 2).alias("horizon"))


@query
def drop_known_skips(spark, sf):
    skips = E.event_outcomes(spark, sf).filter(F.col("outcome") == "skipped").select(*outcomes.SKIP_COLUMNS)
    routed = E.event_deliveries(spark, sf)
    left = routing.drop_known_skips(routed, skips, _horizons(spark, sf), E.PARTITIONS)
    return left.select("destination_id", "partition", "offset")


@query
def envelopes(spark, sf):
    members = (
        "data_source_id string, data_source_description string, data_destination_id string, "
        "data_destination_description string, payload struct<id: bigint, event_id: string, recorded_on: string, score: double, payload: string>"
    )
    due = E.routed_records(spark, sf).filter((F.col("outcome").isNull()) & (F.col("destination_id") == "sales"))
    bodies = routing.envelopes(due).select("partition", "offset", F.from_json("body", members).alias("b"))
    payload = [f"b.payload.{c}" for c in ("id", "event_id", "recorded_on", "score", "payload")]
    return bodies.select(
        "partition", "offset", "b.data_source_id", "b.data_source_description", "b.data_destination_id",
        "b.data_destination_description", *payload,
    )


@query
def headers(spark, sf):
    with_headers = routing.headers(E.event_deliveries(spark, sf))
    names = {
        "event_id": "X-Relay-Event-ID",
        "generation": "X-Relay-Delivery-Generation",
        "replay": "X-Relay-Replay",
        "topic": "X-Relay-Topic",
        "partition": "X-Relay-Partition",
        "offset": "X-Relay-Offset",
        "idempotency_key": "Idempotency-Key",
        "content_type": "Content-Type",
    }
    return with_headers.select(*[F.col("headers")[header].alias(name) for name, header in names.items()])


# --- outcomes ------------------------------------------------------------------------------------


@query
def classify_responses(spark, sf):
    classified = outcomes.classify_responses(E.event_attempts(spark, sf))
    return classified.select("destination_id", "id", "attempt", "status", "outcome", "retry_reason")


@query
def resolve_attempts(spark, sf):
    return outcomes.resolve_attempts(outcomes.classify_responses(E.event_attempts(spark, sf))).drop("topic")


@query
def retry_schedule(spark, sf):
    attempts = E.event_attempts(spark, sf).select(*outcomes.RECORD_KEY, "id", "attempt", F.lit(0.0).alias("u"))
    return outcomes.retry_schedule(attempts).select("destination_id", "id", "attempt", "wait_seconds", "due_seconds")


@query
def commit_frontier(spark, sf):
    return outcomes.commit_frontier(E.event_outcomes(spark, sf))


@query
def pending(spark, sf):
    frontier = outcomes.commit_frontier(E.event_outcomes(spark, sf))
    left = outcomes.pending(E.event_deliveries(spark, sf), frontier, 2 * E.PARTITIONS)
    return left.select("destination_id", "partition", "offset", "event_id")


@query
def save_skips(spark, sf):
    """The skips of signups and errors are stored already; saving all adds the others once."""
    found = E.event_outcomes(spark, sf).filter(F.col("outcome") == "skipped")
    stored = found.filter(F.col("event_name").isin("signup", "error")).select(*outcomes.SKIP_COLUMNS)
    return outcomes.save_skips(stored, found).drop("topic")


def _partition_facts(spark, sf):
    """Bounds, commits and started marks per user-type partition, with lost history in some."""
    bounds = (
        E.event_records(spark, sf)
        .groupBy(F.col("event_name").alias("destination_id"), "topic", "partition")
        .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("end_offset"))
    )
    bounds = bounds.withColumn("first_offset", F.when(F.col("partition") % 5 == 1, F.col("low")).otherwise(0).cast("long"))
    committed = bounds.filter(F.col("partition") % 3 != 0).select(
        "destination_id", "topic", "partition",
        F.when(F.col("partition") == 7, F.col("end_offset") + 1).otherwise(F.floor(F.col("end_offset") / 2)).alias("committed"),
    )
    started = bounds.filter((F.col("partition") % 3 != 0) | (F.col("partition") == 9)).select("destination_id", "topic", "partition")
    return bounds.drop("low"), committed, started


@query
def check_history(spark, sf):
    return outcomes.check_history(*_partition_facts(spark, sf)).drop("topic")


@query
def mark_started(spark, sf):
    bounds, _, started = _partition_facts(spark, sf)
    begun = bounds.filter(F.col("first_offset") == 0)
    return outcomes.mark_started(started, begun).drop("topic")


@query
def dedupe_deliveries(spark, sf):
    """Every attempt that reached the receiver, once per idempotency key."""
    received = E.event_attempts(spark, sf).select(
        keys.idempotency_key(F.concat(F.lit("evt_"), F.col("id")), F.col("destination_id"), F.lit(1)).alias("idempotency_key"),
        "destination_id",
        "id",
    )
    return outcomes.dedupe_deliveries(received)


@query
def dedupe_stream(spark, sf):
    """Every attempt that reached the receiver, received twice in two batches of a stream, once per idempotency key."""
    path, out, checkpoint = (shared_dir(spark, n) for n in ("received", "deduped", "checkpoint"))
    received = E.event_attempts(spark, sf).select(
        keys.idempotency_key(F.concat(F.lit("evt_"), F.col("id")), F.col("destination_id"), F.lit(1)).alias("idempotency_key"),
        "destination_id",
        "id",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("received_at"),
    )
    received.coalesce(1).write.parquet(path)
    later = (F.col("received_at") + F.expr("interval 1 hour")).alias("received_at")
    spark.read.parquet(path).select("idempotency_key", "destination_id", "id", later).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(received.schema).option("maxFilesPerTrigger", 1).parquet(path)
    unique = outcomes.dedupe_deliveries(stream, "received_at", "1 day")
    writer = unique.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.format("parquet").start(out).awaitTermination()
    return spark.read.schema(received.schema).parquet(out).drop("received_at")


@query
def deliver_in_order(spark, sf):
    """Pushed through a sender on the executors; each partition stops at its first stuck record."""
    due = E.event_deliveries(spark, sf).withColumn("payload", F.to_json(F.struct("id")))
    requests = routing.headers(routing.envelopes(due))
    path = shared_dir(spark, "sent")
    deliver(requests, scripted_sender(), 3, 2 * E.PARTITIONS, sleep=_no_sleep).write.parquet(path)
    sent = spark.read.parquet(path)
    return sent.select("destination_id", "partition", "offset", "outcome", F.size("attempts").cast("long").alias("attempts"))


def _no_sleep(_: float) -> None:
    return None


def scripted_sender():
    """A sender that answers by the record's id the way ``event_table`` responds; no network."""
    import json

    calls: dict[tuple[str, int], int] = {}

    def send(body: str, headers: dict) -> tuple[int, str]:
        request = json.loads(body)
        serial = request["payload"]["id"]
        place = (request["data_destination_id"], serial)
        n = calls[place] = calls.get(place, -1) + 1
        if serial % 101 == 50:
            return 503, ""
        if serial % 103 == 51:
            return 200, E.SUCCESS.ljust(64 << 10)
        if serial % 103 == 52:
            return 200, E.SUCCESS.ljust((64 << 10) + 1) if n == 0 else E.SUCCESS
        if serial % 7 == 3:
            return (503, "") if n == 0 else (200, E.SUCCESS)
        if serial % 11 == 5:
            return 200, E.KEEP_GOING
        if serial % 13 == 6:
            return [(200, '{"result":{}}'), (302, ""), (200, E.SUCCESS)][min(n, 2)]
        return 200, E.SUCCESS

    return send


def accepting_sender():
    def send(body, headers):
        return 200, E.SUCCESS

    return send


@query
def stream_delivery(spark, sf):
    """The whole chain as a stream: follow, decode, route, filter, send, audit, commit."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    changes.write_changes(E.events_log(spark, sf), log)
    job = DeliveryJob(
        spark, E.SCOPE, [CapturedSource(E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC)], E.DESTINATIONS[1],
        scripted_sender(), log, state, sleep=_no_sleep,
    )
    start_delivery(job, available_now=True).awaitTermination()
    done = job.outcomes().filter(F.col("outcome").isNotNull())
    counts = done.groupBy("partition", "outcome").agg(F.count(F.lit(1)).alias("records"))
    return counts.join(job.positions().select("partition", "committed"), "partition")


def _middle(bounds) -> list[tuple]:
    """From a quarter to the half of each log partition."""
    return [(b["topic"], b["partition"], b["end_offset"] // 4, b["end_offset"] // 2) for b in bounds]


@query
def replay_requests(spark, sf):
    """Requests of a bounded replay, as a batch: the recorded ranges only, and the replay header says so."""
    # One row per log partition.
    ranges = _middle(changes.log_bounds(E.events_log(spark, sf)).collect())
    again = replay_records(E.decoded_events(spark, sf).drop("row"), ranges)
    subs = routing.subscriptions(routing.destinations_frame(spark, E.DESTINATIONS[:2]))
    due = routing.apply_filters(routing.route(again, subs)).filter(F.col("outcome").isNull())
    sent = routing.headers(routing.envelopes(due))
    names = {"event_id": "X-Relay-Event-ID", "replay": "X-Relay-Replay", "partition": "X-Relay-Partition", "offset": "X-Relay-Offset"}
    return sent.select("destination_id", *[F.col("headers")[h].alias(c) for c, h in names.items()])


@query
def replay_stream(spark, sf):
    """A bounded replay after normal delivery: its own ranges and positions, stopped and gone on with, normal positions untouched."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    segments.write_segment(E.events_log(spark, sf), log)
    segments.index_log(spark, log)
    sources = [CapturedSource(E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC)]
    parts = (spark, E.SCOPE, sources, E.DESTINATIONS[1], accepting_sender(), log, state)
    normal = DeliveryJob(*parts, sleep=_no_sleep)
    start_delivery(normal, available_now=True).awaitTermination()
    before = normal.positions().select("partition", F.col("committed").alias("normal_committed"))
    ranges = _middle(segments.log_bounds(spark, log).collect())
    starts, ends = {tuple(r[:2]): r[2] for r in ranges}, {tuple(r[:2]): r[3] for r in ranges}
    first = ReplayJob(*parts, sleep=_no_sleep, replay_id="rebuild", round_size=20)
    first.create(starts, ends, fresh_target=True, revision="r1")
    first._open()
    first.round()
    # Another process takes it up where it is.
    job = ReplayJob(*parts, sleep=_no_sleep, replay_id="rebuild")
    state_then = job.run()
    counts = job.outcomes().groupBy("partition", "outcome").agg(F.count(F.lit(1)).alias("records"))
    told = F.lit(state_then).alias("state")
    return counts.join(job.positions().select("partition", "committed"), "partition").join(before, "partition").select("*", told)


@query
def rest_on_blocked_source(spark, sf):
    """A destination of two sources: after one of them is blocked, new records of the other stay where they are."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    events = E.events_log(spark, sf)
    changes.write_changes(events.filter(F.col("offset") % 2 == 0).withColumn("offset", F.floor(F.col("offset") / 2)), log)
    sources = [
        CapturedSource(E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC),
        CapturedSource(E.ORDERS, E.orders_identity(spark, sf), E.ORDERS_TOPIC),
    ]
    job = DeliveryJob(spark, E.SCOPE, sources, E.DESTINATIONS[4], accepting_sender(), log, state, sleep=_no_sleep)
    start_delivery(job, available_now=True).awaitTermination()
    # A record of the other source that can't be decoded.
    bad = E.table(spark, sf, "region").limit(1).select(
        F.lit(E.ORDERS_TOPIC).alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.lit("{}").alias("key"), F.lit("{}").alias("value"),
    )
    changes.write_changes(bad, log)
    start_delivery(job, available_now=True).awaitTermination()
    sent = job.outcomes().count()
    first = events.groupBy("partition").agg(F.count_if(F.col("offset") % 2 == 0).alias("e"), F.count(F.lit(1)).alias("n"))
    more = events.join(first, "partition").filter((F.col("offset") % 2 == 1))
    moved = more.select("topic", "partition", (F.col("e") + F.floor(F.col("offset") / 2)).alias("offset"), "key", "value")
    changes.write_changes(moved, log)
    start_delivery(job, available_now=True).awaitTermination()
    counts = job.outcomes().groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"))
    (down,) = job.blocked().collect()
    after = job.outcomes().count() - sent
    return counts.filter(F.col("topic") == E.EVENTS_TOPIC).select(
        "partition", "records", F.lit(down["source_id"]).alias("down"), F.lit(down["reason"]).alias("reason"), F.lit(after).cast("long").alias("sent_after_block")
    )


@query
def unfinished_tail(spark, sf):
    """Stuck records hold their partitions over a restart; once the destination accepts them, the tail goes out."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    changes.write_changes(E.events_log(spark, sf), log)
    sources = [CapturedSource(E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC)]

    def run(sender) -> DeliveryJob:
        job = DeliveryJob(spark, E.SCOPE, sources, E.DESTINATIONS[1], sender, log, state, sleep=_no_sleep)
        start_delivery(job, available_now=True).awaitTermination()
        return job

    run(scripted_sender())
    job = run(accepting_sender())
    counts = job.outcomes().groupBy("partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("outcome").isNull()).alias("unfinished"), F.count_if(F.col("outcome") == "filtered").alias("filtered")
    )
    return counts.join(job.positions().select("partition", "committed", "tried"), "partition")


@query
def lost_history(spark, sf):
    """A log that has lost what was committed blocks its source and sends nothing."""
    log, state = shared_dir(spark, "log"), shared_dir(spark, "state")
    events = E.events_log(spark, sf)
    changes.write_changes(events, log)
    sources = [CapturedSource(E.EVENTS, E.events_identity(spark, sf), E.EVENTS_TOPIC)]
    job = DeliveryJob(spark, E.SCOPE, sources, E.DESTINATIONS[1], accepting_sender(), log, state, sleep=_no_sleep)
    start_delivery(job, available_now=True).awaitTermination()
    job.log_path = shared_dir(spark, "log")
    changes.write_changes(events.filter(F.col("offset") < 3), job.log_path)
    try:
        start_delivery(job, available_now=True)
        state_found = "running"
    except HistoryLost:
        state_found = "stopped"
    (down,) = job.blocked().collect()
    sent = job.outcomes().groupBy("partition").agg(F.count(F.lit(1)).alias("records"))
    return sent.withColumns({"source_id": F.lit(down["source_id"]), "reason": F.lit(down["reason"]), "state": F.lit(state_found)})


# --- state tables --------------------------------------------------------------------------------


@query
def insert_if_absent(spark, sf):
    """Subscriptions of all customers; those in debt are stored already, paused."""
    customer = E.table(spark, sf, "customer")
    stored = customer.filter(F.col("c_acctbal") < 0).select(
        F.col("c_name").alias("destination_id"), F.lit("paused").alias("desired"), F.col("c_custkey").alias("revision")
    )
    ids = E.orders(spark, sf).join(customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("destination_id"))
    return tables.ensure_subscriptions(stored, ids, ["destination_id"])


@query
def fold_desired(spark, sf):
    """Every event is a command of its user: errors pause, the rest resume, clicks are not commands."""
    commands = E.table(spark, sf, "events").select(
        "user_id",
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "paused").when(F.col("event_type") == "click", "noise").otherwise("running").alias("state"),
    )
    stored = commands.select("user_id").distinct().select(
        "user_id",
        F.when(F.col("user_id") % 2 == 0, "running").otherwise("paused").alias("desired"),
        F.lit(1).cast("long").alias("revision"),
    )
    return tables.fold_desired(stored, commands, ["user_id"])


def _observations(spark, sf) -> DataFrame:
    return E.table(spark, sf, "events").select(
        "user_id",
        F.col("event_type").alias("destination_id"),
        F.floor(F.col("value") / 10).alias("revision"),
        F.col("event_id").alias("arrival"),
        F.when(F.col("event_id") % 2 == 0, "running").otherwise("paused").alias("state"),
    )


@query
def latest_by_revision(spark, sf):
    return tables.latest_by_revision(_observations(spark, sf), ["user_id", "destination_id"])


@query
def observed_everywhere(spark, sf):
    """Has every user of a destination observed it running at revision 1 or later?"""
    latest = tables.latest_by_revision(_observations(spark, sf), ["user_id", "destination_id"])
    members = E.table(spark, sf, "events").select(
        F.col("event_type").alias("destination_id"),
        F.pmod("user_id", F.lit(25)).alias("worker_group"),
        "user_id",
        F.lit(1).alias("wanted_revision"),
        F.lit("running").alias("wanted_state"),
    ).distinct()
    seen = latest.withColumn("worker_group", F.pmod("user_id", F.lit(25)))
    return tables.observed_everywhere(members, seen, ["destination_id", "worker_group"], "user_id", "wanted_revision", "wanted_state")


@query
def terminal_everywhere(spark, sf):
    done = E.event_outcomes(spark, sf)
    return tables.terminal_everywhere(E.event_deliveries(spark, sf), done).drop("topic")


@query
def latch_blocks(spark, sf):
    events = E.table(spark, sf, "events").select(
        F.col("user_id").alias("source_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", F.col("props")).otherwise("").alias("reason"),
    )
    return tables.latch_blocks(events)


@query
def state_changes(spark, sf):
    observed = E.table(spark, sf, "events").select(
        F.col("user_id").alias("source_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type").isin("error", "view"), "blocked").otherwise("running").alias("state"),
        F.when(F.col("event_type") == "error", "failed").alias("reason"),
    )
    return tables.state_changes(observed)


@query
def health_rollup(spark, sf):
    """Health per customer: the customer is the source, the orders are the subscriptions."""
    sources = E.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("owner"), F.when(F.col("c_acctbal") > -500, "running").otherwise("blocked").alias("state")
    )
    status = F.col("o_orderstatus")
    subscriptions = E.orders(spark, sf).select(
        F.col("o_custkey").alias("owner"),
        F.when(status == "O", "running").when(status == "F", "paused").otherwise("starting").alias("state"),
    )
    return tables.health_rollup(sources, subscriptions, ["owner"])


@query
def merge_table(spark, sf):
    """Order totals per customer stored first, then the customers' own rows merged over them."""
    path = shared_dir(spark, "state")
    totals = E.orders(spark, sf).groupBy(F.col("o_custkey").alias("owner")).agg(F.count(F.lit(1)).alias("n"), F.lit("orders").alias("origin"))
    tables.merge_table(path, totals, ["owner"], "insert")
    customers = E.table(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("owner"), F.lit(0).cast("long").alias("n"), F.lit("customer").alias("origin")
    )
    return tables.merge_table(path, customers, ["owner"], "upsert")


# --- activity ------------------------------------------------------------------------------------


def _worked_on(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Records each destination has got to, and the attempts at them: all up to the first stuck one."""
    done = E.event_outcomes(spark, sf).withColumn("known_skip", F.lit(False))
    frontier = outcomes.commit_frontier(done)
    reached = done.join(small_side(frontier, 2 * E.PARTITIONS), outcomes.PARTITION_KEY).filter(F.col("offset") <= F.col("committed"))
    records = reached.withColumn("committed", F.col("offset") < F.col("committed"))
    attempts = outcomes.classify_responses(E.event_attempts(spark, sf))
    return records, attempts


@query
def activity_entries(spark, sf):
    entries = activity.activity_entries(*_worked_on(spark, sf))
    return entries.select("destination_id", "partition", "offset", "event_id", "level", "message", "attempt", "outcome", "error")


@query
def activity_round_trip(spark, sf):
    """Entries written as JSON lines and counted by message."""
    path = shared_dir(spark, "activity")
    activity.write_activity(activity.activity_entries(*_worked_on(spark, sf)), path)
    lines = spark.read.schema("message string, destination_id string, attempt int").json(path)
    return lines.groupBy("message", "destination_id").agg(F.count(F.lit(1)).alias("entries"), F.count("attempt").alias("with_attempt"))


def _sequenced_log(spark, sf) -> DataFrame:
    """Every event as one entry, stamped in the order of event ids."""
    entries = E.table(spark, sf, "events").select(
        F.concat(F.lit("evt_"), F.col("event_id")).alias("event_id"),
        F.col("user_id").cast("string").alias("aggregate_id"),
        F.col("event_type").alias("event_name"),
        F.col("event_id").alias("number"),
    )
    return activity.stamped(entries, "boot", F.col("number")).drop("number", "id", "time")


@query
def stamped_activity(spark, sf):
    """What was written for all destinations, stamped, and read back by its cursor."""
    entries = activity.activity_entries(*_worked_on(spark, sf))
    log = activity.stamped(entries, "boot", activity.record_order(), at=F.lit("2024-01-01").cast("timestamp"))
    path = shared_dir(spark, "activity")
    activity.write_activity(log, path)
    kept = "id string, sequence bigint, time timestamp, message string, destination_id string, partition int, attempt int, offset bigint"
    lines = spark.read.schema(kept).json(path)
    return lines.select("id", "sequence", F.date_format("time", "yyyy-MM-dd").alias("day"), "message", "destination_id", "partition", "attempt", "offset")


@query
def state_change_entries(spark, sf):
    """Changes of source states as entries, stamped in their order."""
    entries = activity.state_entries(state_changes(spark, sf).withColumn("source_id", F.col("source_id").cast("string")))
    return activity.stamped(entries, "boot", F.col("seq")).select("id", "source_id", "message", "error", "level")


@query
def retain_last(spark, sf):
    return activity.retain_last(_sequenced_log(spark, sf))


@query
def read_after(spark, sf):
    """A recent cursor, one that is too old, and one of another boot."""
    log = _sequenced_log(spark, sf)
    _, head, _ = activity.read_after(log, "boot")
    last = int(head.split(":")[1])
    pages = []
    for cursor in (f"boot:{last - 300}", f"boot:{max(last - activity.RETAINED - 1, 0)}", f"other:{last}"):
        entries, next_cursor, reset = activity.read_after(log, "boot", cursor)
        pages.append(
            entries.select("sequence", "event_id").withColumns(
                {"cursor": F.lit(cursor), "next_cursor": F.lit(next_cursor), "reset": F.lit(reset)}
            )
        )
    return _union(pages)


@query
def find_activity(spark, sf):
    return activity.find_activity(_sequenced_log(spark, sf), event_name="purchase").unionByName(
        activity.find_activity(_sequenced_log(spark, sf), event_id="evt_7", event_name="click")
    )


#: Appends of a stored log: shares of all its entries, uneven, the last one small.
_APPENDED = (0.02, 0.4, 0.41, 0.99, 1.0)


def _stored_log(spark, sf) -> ActivityLog:
    """Every event as one entry, appended in several steps."""
    log = ActivityLog(spark, shared_dir(spark, "activity"))
    entries = _sequenced_log(spark, sf).withColumn("id", keys.cursor_for(F.lit("boot"), F.col("sequence")))
    path = shared_dir(spark, "entries")
    entries.write.parquet(path)
    entries = spark.read.parquet(path)
    n, low = entries.count(), 0
    for share in _APPENDED:
        high = int(n * share)
        log.append(entries.filter((F.col("sequence") > low) & (F.col("sequence") <= high)), "boot")
        low = high
    return log


@query
def retained_activity(spark, sf):
    """What a stored log has left as lines after its appends, read by a recent cursor, one that is too old, and one of another boot."""
    log = _stored_log(spark, sf)
    last = log.last("boot")
    pages = [log.recent().select("sequence", "event_id", F.lit("kept").alias("cursor"), F.lit(False).alias("reset"))]
    for cursor in (f"boot:{last - 300}", f"boot:{max(last - activity.RETAINED - 1, 0)}", f"other:{last}"):
        entries, _, reset = log.read_after("boot", cursor)
        pages.append(entries.select("sequence", "event_id", F.lit(cursor).alias("cursor"), F.lit(reset).alias("reset")))
    return _union(pages)


@query
def activity_lookup(spark, sf):
    """Entries of a stored log by identifier, trimmed ones too."""
    log = _stored_log(spark, sf)
    found = log.find(event_name="purchase").unionByName(log.find(event_id="evt_7")).unionByName(log.find(aggregate_id="11", event_name="click"))
    return found.select("id", "sequence", "event_id", "aggregate_id", "event_name")
