"""The activity log: entries of what happened to each record, and bounded reads of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relaylog.functions.keys import cursor_for, parse_cursor
from relaylog.operators.outcomes import RECORD_KEY
from relaylog.operators.scale import numbered

RETAINED = 1000

# Messages and the one error text an attempt entry may carry.
STARTED = "delivery started"
ACKNOWLEDGED = "acknowledged"
RETRY = "retry"
TERMINAL = "terminal outcome"
COMMITTED = "committed"
RETRY_ERROR = "delivery failed or retry requested"

_RECORD = ["source_id", "destination_id", "generation", "topic", "partition", "offset", "event_id", "aggregate_id", "event_name"]


class InvalidCursor(ValueError):
    """A cursor that is not ``boot:sequence``."""


_ENTRY = "array<struct<step:bigint,level:string,message:string,attempt:int,outcome:string,error:string>>"

# Places of a record's entries among each other: started, attempts from 1 on, then the outcome and the commit.
_LAST_ATTEMPT = (1 << 22) - 1


def _entry(step, message, level="info", attempt=None, outcome=None, error=None) -> Column:
    values = {"step": step, "level": level, "message": message, "attempt": attempt, "outcome": outcome, "error": error}
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()])


def activity_entries(records: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """All entries for records that were worked on.

    ``records``: the record columns plus ``outcome`` (null while retrying), ``known_skip``, ``committed`` and, if it was
    tried before, ``tried``. ``attempts``: position key, 0-based ``attempt`` and its own ``outcome`` (null = retry).
    Without that frame, ``records`` holds its attempts in order, in a column ``attempts`` as ``deliver`` returns it.
    A record's attempts are joined to it once, and one generator makes its entries. ``step`` orders them.
    """
    if attempts is None:
        joined = records.withColumn("tries", F.transform("attempts", lambda a: F.struct(a["attempt"], a["outcome"].alias("result"))))
    else:
        tries = F.sort_array(F.collect_list(F.struct("attempt", F.col("outcome").alias("result")))).alias("tries")
        joined = records.join(attempts.groupBy(*RECORD_KEY).agg(tries), RECORD_KEY, "left")
    sent = ~F.col("known_skip")

    def tried(t: Column) -> Column:
        retried = t["result"].isNull()
        return _entry(
            F.least(t["attempt"] + 1, F.lit(_LAST_ATTEMPT)).cast("long"),
            F.when(retried, RETRY).otherwise(ACKNOWLEDGED),
            F.when(retried, "warn").otherwise("info"),
            (t["attempt"] + 1).cast("int"),
            F.lit(None).cast("string"),
            F.when(retried, RETRY_ERROR),
        )

    def some(condition: Column, entry: Column) -> Column:
        return F.when(condition, F.array(entry).cast(_ENTRY)).otherwise(F.array().cast(_ENTRY))

    fresh = F.col("tried") == 0 if "tried" in records.columns else F.lit(True)
    entries = F.concat(
        some(sent & fresh, _entry(F.lit(0), STARTED)),
        F.when(sent & F.col("tries").isNotNull(), F.transform("tries", tried).cast(_ENTRY)).otherwise(F.array().cast(_ENTRY)),
        some(sent & F.col("outcome").isNotNull(), _entry(F.lit(_LAST_ATTEMPT + 1), TERMINAL, outcome=F.col("outcome"))),
        some(F.col("committed"), _entry(F.lit(_LAST_ATTEMPT + 2), COMMITTED)),
    )
    rows = joined.select(*_RECORD, F.inline(entries))
    return rows.select("level", "message", *_RECORD, "attempt", "outcome", "error", "step")


def state_entries(changes: DataFrame, who: str = "source_id") -> DataFrame:
    """Entries for state changes (``tables.state_changes``) of sources, or of destinations by ``who="destination_id"``."""
    message = F.concat(F.lit("source "), "state") if who == "source_id" else F.col("state")
    named = {"level": F.lit("info"), "message": message, **{c: F.lit(None) for c in _RECORD}, who: F.col(who), "error": F.col("reason")}
    types = {"generation": "int", "partition": "int", "offset": "bigint"}
    return changes.select("seq", *[v.cast(types.get(k, "string")).alias(k) for k, v in named.items()])


def stamped(entries: DataFrame, boot: str, order: Column, after: int = 0, at: Column | None = None) -> DataFrame:
    """``entries`` with ``sequence`` (gapless from ``after`` + 1, by ``order``), ``id`` and ``time``.

    ``order`` is a whole number, or a struct that begins with one; its other fields decide between equal numbers. ``boot``
    names one life of the log, as in its cursors. Entries that are equal in all of ``order`` get any order.
    """
    placed = entries.withColumn("__order", order)
    kind = placed.schema["__order"].dataType
    # The number alone cuts the chunks; the rest of a struct only sorts within one.
    first = F.col("__order")[kind.names[0]] if isinstance(kind, StructType) else F.col("__order")
    placed = placed.withColumn("__number", first.cast("long"))
    numbers = numbered(placed, [], "__number", "sequence", ties=["__order"]).drop("__order", "__number")
    numbers = numbers.withColumn("sequence", F.col("sequence") + after + 1)
    time = F.current_timestamp() if at is None else at
    return numbers.withColumn("id", cursor_for(F.lit(boot), F.col("sequence"))).withColumn("time", time)


def record_order() -> Column:
    """The order of ``activity_entries`` for ``stamped``: by offset, and a record's entries as they happened."""
    return F.struct("offset", "destination_id", "topic", "partition", "step")


def write_activity(entries: DataFrame, path: str, mode: str = "append") -> None:
    """Write every entry as one JSON line; absent fields are left out."""
    entries.write.mode(mode).json(path)


def retain_last(log: DataFrame, n: int = RETAINED) -> DataFrame:
    """The newest ``n`` entries, oldest first: a top-n per task, then one merge."""
    return log.orderBy(F.desc("sequence")).limit(n).orderBy("sequence")


def read_after(
    log: DataFrame, boot: str, cursor: str = "", n: int = RETAINED, last: int | None = None
) -> tuple[DataFrame, str, bool]:
    """(entries after the cursor, next cursor, reset).

    Reset, and a read from the oldest retained entry, when the cursor belongs to another boot, lies in
    the future, or is more than ``n`` entries behind. Only the last sequence number reaches the driver; a caller
    who knows it (``last``) saves the scan for it.
    """
    if last is None:
        last = log.agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
    after, reset = 0, False
    if cursor:
        parsed = log.sparkSession.range(1).select(parse_cursor(F.lit(cursor)).alias("c")).first()["c"]
        if parsed is None:
            raise InvalidCursor("invalid log cursor")
        sequence = int(parsed["sequence"])
        reset = parsed["boot"] != boot or sequence > last or last - sequence > n
        after = 0 if reset else sequence
    entries = log.filter(F.col("sequence") > max(after, last - n)).orderBy("sequence")
    return entries, f"{boot}:{last}", reset


def find_activity(
    log: DataFrame, event_id: str | None = None, aggregate_id: str | None = None, event_name: str | None = None
) -> DataFrame:
    """Entries by the identifiers they carry."""
    wanted = {"event_id": event_id, "aggregate_id": aggregate_id, "event_name": event_name}
    for name, value in wanted.items():
        if value is not None:
            log = log.filter(F.col(name) == value)
    return log
