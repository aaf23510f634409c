"""Attempts to outcomes, outcomes to progress: retries, the commit frontier, skips and lost history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.functions.acks import classify_response
from relaylog.functions.keys import backoff_seconds
from relaylog.operators.scale import running_sum, small_side

RECORD_KEY = ["destination_id", "topic", "partition", "offset"]
OUTCOMES = ["delivered", "filtered", "skipped"]
PARTITION_KEY = ["destination_id", "topic", "partition"]


def classify_responses(attempts: DataFrame) -> DataFrame:
    """Add ``outcome`` and ``retry_reason`` to attempts with ``status`` and ``body``."""
    # ``inline`` keeps the body from being read once per output column or filter on it.
    classified = attempts.withColumn("classified", classify_response(F.col("status"), F.col("body")))
    return classified.select(*attempts.columns, F.inline(F.array("classified")))


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """One row per destination and record: the first non-retry attempt decides, later ones are ignored.

    ``outcome`` is null while every attempt asked for a retry. Plain aggregates, combined map-side.
    """
    # Attempt and outcome in one number: a minimum over text would sort all attempts instead of hashing them.
    codes = F.array(*[F.lit(o) for o in OUTCOMES])
    code = F.col("attempt").cast("long") * len(OUTCOMES) + F.array_position(codes, F.col("outcome")) - 1
    resolved = attempts.groupBy(*RECORD_KEY).agg(F.min(code).alias("first_outcome"), F.max("attempt").alias("last_attempt"))
    attempt = F.floor(F.col("first_outcome") / len(OUTCOMES))
    return resolved.select(
        *RECORD_KEY,
        F.get(codes, F.pmod("first_outcome", F.lit(len(OUTCOMES))).cast("int")).alias("outcome"),
        (F.coalesce(attempt, F.col("last_attempt")) + 1).cast("long").alias("attempts_used"),
    )


def retry_schedule(attempts: DataFrame, chunks: int | None = None) -> DataFrame:
    """``wait_seconds`` after each attempt and ``due_seconds``, when the next one is due since the first.

    ``attempt`` counts from 0 per record, ``u`` in [0, 1) is the jitter.
    """
    waits = attempts.withColumn("wait_seconds", backoff_seconds(F.col("attempt"), F.col("u")))
    return running_sum(waits, RECORD_KEY, "attempt", F.col("wait_seconds"), "due_seconds", chunks)


def commit_frontier(outcomes: DataFrame) -> DataFrame:
    """Per destination and log partition: the first offset without an outcome, else the end."""
    unfinished = F.min(F.when(F.col("outcome").isNull(), F.col("offset")))
    return outcomes.groupBy(*PARTITION_KEY).agg(F.coalesce(unfinished, F.max("offset") + 1).alias("committed"))


def pending(routed: DataFrame, frontier: DataFrame, frontier_rows: int) -> DataFrame:
    """What is still to send. Partitions without a frontier have not begun, so all of it is pending.

    ``frontier_rows`` bounds the frontier: destinations x log partitions.
    """
    joined = routed.join(small_side(frontier, frontier_rows), PARTITION_KEY, "left")
    return joined.filter(F.col("offset") >= F.coalesce(F.col("committed"), F.lit(0))).drop("committed")


SKIP_COLUMNS = ["destination_id", "source_id", "event_id", "topic", "partition", "offset"]


def new_skips(skips: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Skips to store before the frontier passes them; already stored positions are left out."""
    found = outcomes.filter(F.col("outcome") == "skipped").select(*SKIP_COLUMNS).dropDuplicates(RECORD_KEY)
    return found.join(skips, RECORD_KEY, "left_anti")


def save_skips(skips: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The skip table after these outcomes. The key is the position; repeating changes nothing."""
    return skips.select(*SKIP_COLUMNS).unionByName(new_skips(skips, outcomes))


# Why a partition may not be read on.
HISTORY_LOST = "established consumer offsets or history lost"
OUT_OF_RANGE = "committed offset is outside retained history"


def check_history(bounds: DataFrame, committed: DataFrame, started: DataFrame) -> DataFrame:
    """Per destination and partition: ``state`` (running, blocked), ``reason`` and ``baseline``.

    ``bounds``: destination_id, topic, partition, first_offset, end_offset. A partition without a
    commit must never have been started and must still begin at 0; a commit must be inside the log.
    """
    marks = started.select(*PARTITION_KEY).distinct().withColumn("started", F.lit(True))
    joined = bounds.join(committed, PARTITION_KEY, "left").join(marks, PARTITION_KEY, "left")
    no_commit = F.col("committed").isNull()
    lost = no_commit & (F.coalesce(F.col("started"), F.lit(False)) | (F.col("first_offset") != 0))
    outside = ~no_commit & ~F.col("committed").between(F.col("first_offset"), F.col("end_offset"))
    reason = F.when(lost, HISTORY_LOST).when(outside, OUT_OF_RANGE)
    return joined.select(
        *PARTITION_KEY,
        F.when(reason.isNull(), "running").otherwise("blocked").alias("state"),
        reason.alias("reason"),
        F.when(reason.isNull(), F.coalesce("committed", "first_offset")).alias("baseline"),
    )


def mark_started(started: DataFrame, begun: DataFrame) -> DataFrame:
    """The started table after these partitions have begun. Repeating changes nothing."""
    new = begun.select(*PARTITION_KEY).distinct().join(started, PARTITION_KEY, "left_anti")
    return started.select(*PARTITION_KEY).unionByName(new)


def dedupe_deliveries(received: DataFrame, received_at: str | None = None, within: str = "1 day") -> DataFrame:
    """The receiver's side of at-least-once delivery: one row per idempotency key.

    On a stream, a key is kept for ``within`` after its first row by the time column ``received_at``, then its state goes. A
    duplicate that comes while the key is kept is dropped, and so is any row that is behind the watermark when it comes: what is
    later than ``within`` counts as delivered. ``within`` must be longer than a sender goes on retrying.
    """
    if not received.isStreaming:
        return received.dropDuplicates(["idempotency_key"])
    if received_at is not None:
        received = received.withWatermark(received_at, within)
    return received.dropDuplicatesWithinWatermark(["idempotency_key"])
