"""Identifiers and schedules derived from a record's position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaylog.model import Scope


def stable_event_id(event_id: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """The event's own id, else a digest of its position."""
    position = F.sha2(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string")), 256)
    return F.when(event_id != "", event_id).otherwise(position)


def idempotency_key(stable_id: Column, destination: Column, generation: Column) -> Column:
    return F.concat_ws(":", stable_id, destination, generation.cast("string"))


def backoff_seconds(attempt: Column, u: Column) -> Column:
    """Wait after 0-based ``attempt``: half of a doubling ceiling plus ``u`` of the other half, 1 to 60 s."""
    ceiling = F.expr("1D") * F.pow(F.lit(2.0), F.least(attempt, F.lit(6)))
    delay = ceiling / 2 + u * (ceiling / 2)
    return F.least(F.greatest(delay, F.lit(1.0)), F.lit(60.0))


def delivery_group(scope: Scope, destination: str) -> str:
    return f"{scope.namespace}.{scope.environment}.{destination}.g{scope.generation}"


def cursor_for(boot: Column, sequence: Column) -> Column:
    return F.concat_ws(":", boot, sequence.cast("string"))


_CURSOR = r"\A([^:]+):([0-9]+)\z"
# Sequence numbers are unsigned 64-bit, wider than any Spark integer.
_MAX_SEQUENCE = "18446744073709551615"


def parse_cursor(cursor: Column) -> Column:
    """struct(boot, sequence), or null when the cursor is invalid."""
    sequence = F.regexp_extract(cursor, _CURSOR, 2).try_cast("decimal(38,0)")
    valid = cursor.rlike(_CURSOR) & (sequence <= F.lit(_MAX_SEQUENCE).cast("decimal(38,0)"))
    return F.when(valid, F.struct(F.regexp_extract(cursor, _CURSOR, 1).alias("boot"), sequence.alias("sequence")))
