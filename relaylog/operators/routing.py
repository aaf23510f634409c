"""Fan-out of records to destinations, value filters, and the gates that hold records back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.functions.filters import matches_strings
from relaylog.functions.keys import idempotency_key, stable_event_id
from relaylog.model import Destination
from relaylog.operators.scale import small_side

FILTER_TYPE = "struct<column: string, values: array<string>>"
POSITION = ["topic", "partition", "offset"]


def destinations_frame(spark: SparkSession, destinations: list[Destination]) -> DataFrame:
    """One row per destination, as literals: unlike a frame made from Python rows, Spark knows its size."""

    def texts(values: tuple[str, ...]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    def row(d: Destination) -> Column:
        wanted = d.filter and F.struct(F.lit(d.filter.column).alias("column"), texts(d.filter.values).alias("values"))
        return F.struct(
            F.lit(d.id).alias("destination_id"),
            F.lit(d.description).alias("destination_description"),
            texts(d.sources).alias("sources"),
            (wanted if wanted is not None else F.lit(None)).cast(FILTER_TYPE).alias("filter"),
        )

    return spark.range(1).select(F.inline(F.array(*[row(d) for d in destinations])))


def subscriptions(destinations: DataFrame) -> DataFrame:
    """One row per destination and source it lists; ``source_pos`` is the source's place in the list."""
    others = [c for c in destinations.columns if c != "sources"]
    return destinations.select(*others, F.posexplode("sources").alias("source_pos", "source_id"))


def route(records: DataFrame, subs: DataFrame) -> DataFrame:
    """Every record to every destination subscribed to its source; a source nobody lists goes nowhere.

    Subscriptions are configuration, so Spark broadcasts them by their known size. Beyond the
    threshold it is a shuffle join, where AQE splits a source that holds most records.
    """
    return records.join(subs.drop("source_pos"), "source_id")


def apply_filters(routed: DataFrame) -> DataFrame:
    """Add ``outcome``: ``filtered`` where the destination's filter excludes the record, else null."""
    matches = matches_strings(F.col("strings"), F.col("filter.column"), F.col("filter.values"))
    return routed.withColumn("outcome", F.when(~matches, F.lit("filtered")))


def only_running(routed: DataFrame, desired: DataFrame, destinations: int) -> DataFrame:
    """Nothing for paused destinations. ``desired``: ``destination_id, desired``, one row per destination."""
    running = desired.filter(F.col("desired") == "running").select("destination_id")
    return routed.join(small_side(running, destinations), "destination_id", "left_semi")


def ready_destinations(subs: DataFrame, source_states: DataFrame) -> DataFrame:
    """A destination is ready only if every source it lists is running; else the first that is not is named."""
    states = source_states.select("source_id", F.col("state").alias("source_state"))
    joined = subs.join(states, "source_id", "left")
    running = F.coalesce(F.col("source_state") == "running", F.lit(False))
    first_down = F.min_by("source_id", F.when(~running, F.col("source_pos")))
    return joined.groupBy("destination_id").agg(
        F.bool_and(running).alias("ready"),
        F.when(~F.bool_and(running), F.concat(F.lit("source unavailable: "), first_down)).alias("reason"),
    )


def drop_blocked(records: DataFrame, blocked: DataFrame, sources: int) -> DataFrame:
    """Blocked sources dispatch nothing. ``sources`` bounds how many there are."""
    # A source that is one literal for all records would be folded away, and the join would lose its key.
    keyed = records.select("*", F.inline(F.array(F.struct(F.col("source_id").alias("__of")))))
    down = small_side(blocked.select(F.col("source_id").alias("__of")).distinct(), sources)
    return keyed.join(down, "__of", "left_anti").drop("__of")


def split_known_skips(routed: DataFrame, skips: DataFrame, horizons: DataFrame, partitions: int) -> DataFrame:
    """Mark records already skipped for good at this destination and position as ``skipped``.

    Only records that were in the log at start (``offset < horizon``) are looked up; a stored skip
    never suppresses a live record. ``horizons``: ``topic, partition, horizon``, at most ``partitions`` rows.
    The skip table grows with the data: it is joined by position, never broadcast by hint.
    """
    key = ["destination_id", *POSITION]
    known = skips.select(*key).distinct().withColumn("known_skip", F.lit(True))
    start = horizons.select("topic", "partition", "horizon")
    with_horizon = routed.join(small_side(start, partitions), ["topic", "partition"], "left")
    # Live records look up a position no skip can have, each its own: a common null would put them in one task.
    is_old = F.coalesce(F.col("offset") < F.col("horizon"), F.lit(False))
    lookup = with_horizon.withColumn("lookup", F.when(is_old, F.col("offset")).otherwise(-1 - F.col("offset")))
    known = known.withColumnRenamed("offset", "lookup")
    joined = lookup.join(known, ["destination_id", "topic", "partition", "lookup"], "left")
    is_known = F.coalesce(F.col("known_skip"), F.lit(False))
    return joined.withColumn("known_skip", is_known).drop("horizon", "lookup")


def drop_known_skips(routed: DataFrame, skips: DataFrame, horizons: DataFrame, partitions: int) -> DataFrame:
    """What is still to send after the known skips."""
    return split_known_skips(routed, skips, horizons, partitions).filter(~F.col("known_skip")).drop("known_skip")


def envelopes(routed: DataFrame) -> DataFrame:
    """Add ``body``: the request, with the payload's JSON text spliced in as it is."""
    ids = F.to_json(
        F.struct(
            F.col("source_id").alias("data_source_id"),
            F.col("source_description").alias("data_source_description"),
            F.col("destination_id").alias("data_destination_id"),
            F.col("destination_description").alias("data_destination_description"),
        )
    )
    return routed.withColumn(
        "body", F.concat(F.left(ids, F.length(ids) - 1), F.lit(',"payload":'), F.col("payload"), F.lit("}"))
    )


def headers(routed: DataFrame) -> DataFrame:
    """Add ``headers``: the request headers that describe the record."""
    stable = stable_event_id(F.col("event_id"), F.col("topic"), F.col("partition"), F.col("offset"))
    pairs = {
        "Content-Type": F.lit("application/json"),
        "X-Relay-Event-ID": stable,
        "X-Relay-Delivery-Generation": F.col("generation").cast("string"),
        "X-Relay-Replay": F.col("replay").cast("string"),
        "X-Relay-Topic": F.col("topic"),
        "X-Relay-Partition": F.col("partition").cast("string"),
        "X-Relay-Offset": F.col("offset").cast("string"),
        "Idempotency-Key": idempotency_key(stable, F.col("destination_id"), F.col("generation")),
    }
    entries = [x for name, value in pairs.items() for x in (F.lit(name), value)]
    return routed.withColumn("headers", F.create_map(*entries))
