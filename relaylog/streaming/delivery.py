"""Continuous delivery: one Structured Streaming query per destination.

The log itself is the only copy of the records. A query's state is what it has committed per log
partition, kept as small versioned tables next to the appended skips, outcomes and activity. Each
micro-batch learns how far the log reaches, then works in rounds: a round reads at most
``round_size`` records per log partition from the committed offset on, so a task's work is bounded
however large a partition's backlog is. Nothing is skipped: what a round does not finish is read
again from its committed offset, and its attempts are counted on. The decoded records of a round are
deleted once its positions are written; its outcomes and activity stay.

The log is written in order: a writer makes a partition's records visible only after all with lower offsets.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from relaylog.functions.keys import delivery_group
from relaylog.model import RAW_RECORD, Destination, Identity, Scope, Source
from relaylog.operators import activity, decode, outcomes, routing, tables
from relaylog.operators.deliver import Sender, deliver
from relaylog.operators.scale import few_rows, small_side
from relaylog.sources import segments
from relaylog.sources.activity_log import ActivityLog
from relaylog.sources.changes import log_bounds, read_changes, read_changes_stream

# ``tried``: attempts so far at the record at ``committed``, the one that may still be retrying.
_POSITIONS = (
    "topic string, partition int, first_offset bigint, end_offset bigint, horizon bigint, committed bigint, tried bigint"
)
_SKIPS = "destination_id string, source_id string, event_id string, topic string, partition int, offset bigint"
_BOUNDS = "topic string, partition int, first_offset bigint, end_offset bigint"
_BLOCKED = "source_id string, seq bigint, reason string"
_SENT = "destination_id string, topic string, partition int, offset bigint, outcome string"
_RANGES = "topic string, partition int, low bigint, high bigint, tried bigint"
#: Folders of outcomes, or files of skips, above which they are written together.
_COMPACT = 64


#: Rounds whose records are decoded together.
_ROUNDS_AHEAD = 8
#: Records that are decoded in one task at least.
_DECODED_TOGETHER = 1 << 10

# What the activity and the skips of a round take from its records.
_OF_RECORD = ("source_id", "event_id", "aggregate_id", "event_name", "generation", "known_skip", "tried")

# Hashing places several log partitions in one task now and then; more tasks make that rarer.
_TASKS_PER_PARTITION = 4


class HistoryLost(RuntimeError):
    """The committed position is no longer inside the log; delivery stops instead of starting over."""


@dataclass(frozen=True)
class _Ahead:
    """Decoded records in a folder, and by log partition the first offset and the one after the last of them."""

    folder: str
    schema: StructType
    spans: dict[tuple[str, int], tuple[int, int]]

    def reach(self, topic: str, partition: int) -> tuple[int, int]:
        return self.spans.get((topic, partition), (0, 0))


def _within(records: DataFrame, ranges: list[tuple]) -> DataFrame:
    """The records of ``ranges`` (``_RANGES``), as filters that prune files and a join."""
    near = F.col("topic").isin(sorted({r[0] for r in ranges})) & F.col("partition").isin(sorted({r[1] for r in ranges}))
    near &= (F.col("offset") >= min(r[2] for r in ranges)) & (F.col("offset") < max(r[3] for r in ranges))
    window = small_side(few_rows(records.sparkSession, ranges, _RANGES), len(ranges))
    return records.filter(near).join(window, ["topic", "partition"]).filter("offset >= low and offset < high").drop("low", "high", "tried")


@dataclass(frozen=True)
class CapturedSource:
    source: Source
    identity: Identity
    topic: str


@dataclass
class DeliveryJob:
    """One destination's delivery. ``state_path`` must be on storage every executor can reach."""

    spark: SparkSession
    scope: Scope
    sources: list[CapturedSource]
    destination: Destination
    sender: Sender
    log_path: str
    state_path: str
    max_attempts: int = 3
    round_size: int = 10_000
    # Of a round, at most so many bytes of keys and values per log partition, one record at least.
    round_bytes: int = 5 << 20
    sleep: Callable[[float], None] | None = None
    paused: bool = False
    # How the log is read: format and options of ``read_changes`` and ``read_changes_stream``.
    log_format: str = "parquet"
    log_options: dict = field(default_factory=dict)
    # One life of the activity log, and the number of its last entry.
    boot: str = field(default_factory=lambda: uuid.uuid4().hex)
    sequence: int = 0
    # What the requests' replay header says.
    replay: bool = False
    # Files whose rows were written together elsewhere.
    _replaced: set[str] = field(default_factory=set, repr=False)
    # Records decoded for the next rounds.
    _ahead: _Ahead | None = field(default=None, repr=False)

    def path(self, name: str) -> str:
        return f"{self.state_path}/{delivery_group(self.scope, self.destination.id)}/{name}"

    # Blocks are shared: a source that cannot be decoded is blocked for every destination.
    def blocked_path(self) -> str:
        return f"{self.state_path}/{self.scope.namespace}.{self.scope.environment}.g{self.scope.generation}/blocked"

    def blocked(self) -> DataFrame:
        """Every block has files of its own, so writers can't overwrite each other; the latest reason stands."""
        return tables.latch_blocks(_read_appended(self.spark, self.blocked_path(), _BLOCKED))

    def log(self) -> DataFrame:
        return read_changes(self.spark, self.log_path, self.log_format, **self.log_options)

    def positions(self) -> DataFrame:
        return tables.read_state(self.spark, self.path("positions"), _POSITIONS)

    def skips(self) -> DataFrame:
        files = [path for path in _files(self.spark, self.path("skips")) if path not in self._replaced]
        return self.spark.read.schema(_SKIPS).parquet(*files) if files else few_rows(self.spark, [], _SKIPS)

    def _skips_of(self, ranges: list[tuple]) -> DataFrame:
        """The stored skips that a round can meet: its topics, partitions and offsets, as filters that prune files."""
        near = F.col("topic").isin(sorted({r[0] for r in ranges})) & F.col("partition").isin(sorted({r[1] for r in ranges}))
        return self.skips().filter(near & (F.col("offset") >= min(r[2] for r in ranges)) & (F.col("offset") < max(r[3] for r in ranges)))

    def _bounds(self) -> DataFrame:
        """How far the whole log reaches: by its manifest, where it has one."""
        if self.log_format == "parquet" and not self.log_options:
            bounds = segments.log_bounds(self.spark, self.log_path)
        else:
            bounds = log_bounds(self.log())
        return bounds.filter(F.col("topic").isin(self._topics()))

    def _take(self, seen: DataFrame, at_start: bool) -> None:
        """Take in how far the log reaches; a partition seen first gets its baseline.

        At start ``seen`` covers the whole log: a committed position outside it, or an unknown
        partition that does not begin at 0, is lost history and blocks the source. Later it covers
        the new records only. Records present at start are the ones that can carry a stored skip.
        """
        seen = seen.select("topic", "partition", F.col("first_offset").alias("f"), F.col("end_offset").alias("e"))
        joined = self.positions().join(seen, ["topic", "partition"], "full_outer")
        if at_start:
            first, end = F.coalesce("f", F.lit(0)), F.coalesce("e", F.lit(0))
            horizon, reach = end, F.coalesce("end_offset", first)
        else:
            first, end = F.coalesce("first_offset", "f"), F.greatest("end_offset", "e")
            horizon, reach = F.coalesce("horizon", F.lit(0)), end
        bounds = joined.select(
            F.lit(self.destination.id).alias("destination_id"),
            "topic",
            "partition",
            first.alias("first_offset"),
            end.alias("end_offset"),
            horizon.alias("horizon"),
            reach.alias("reach"),
            "committed",
            "tried",
        )
        known = bounds.filter(F.col("committed").isNotNull()).select(*outcomes.PARTITION_KEY, "committed")
        history = outcomes.check_history(bounds.drop("committed", "horizon", "reach", "tried"), known, known)
        # One row per log partition at most.
        lost = history.filter(F.col("state") == "blocked").collect()
        if lost:
            by_topic = {c.topic: c.source.id for c in self.sources}
            rows = sorted({(by_topic[r["topic"]], 0, r["reason"]) for r in lost})
            self._store_blocks(self.spark.createDataFrame(rows, _BLOCKED))
            raise HistoryLost("; ".join(f"{r['topic']}/{r['partition']}: {r['reason']}" for r in lost))
        state = bounds.select(
            "topic",
            "partition",
            "first_offset",
            F.col("reach").alias("end_offset"),
            "horizon",
            F.coalesce("committed", "first_offset").alias("committed"),
            F.coalesce("tried", F.lit(0)).alias("tried"),
        )
        tables.write_state(state, self.path("positions"))

    def _topics(self) -> list[str]:
        return [c.topic for c in self.sources]

    def down(self) -> list[str]:
        """Sources of this destination that do not run. While there is one, the destination rests.

        Read anew every round, so a block crosses destinations.
        """
        listed = [c.source.id for c in self.sources]
        if not _files(self.spark, self.blocked_path()):
            return []
        blocked = {r["source_id"] for r in self.blocked().filter(F.col("source_id").isin(listed)).collect()}
        return [s for s in listed if s in blocked]

    def round(self, log: DataFrame | None = None) -> bool:
        """One bounded round; false when no partition moved. ``log``: the log with its files already listed."""
        spark = self.spark
        if self.down():
            return False
        # One row per log partition of this generation: bounded by the frozen partition counts.
        state = self.positions().collect()
        positions = [p for p in state if p["topic"] in self._topics()]
        ranges = [
            (p["topic"], p["partition"], p["committed"], min(p["end_offset"], p["committed"] + self.round_size), p["tried"])
            for p in positions
            if p["committed"] < p["end_offset"]
        ]
        if not ranges:
            return False
        partitions = sum(c.identity.partitions for c in self.sources)
        # A round's folder is its own: one that fails or moves nothing keeps what it has written.
        round_path = self.path(f"rounds/{tables.last_version(spark, self.path('positions')):020d}-{uuid.uuid4().hex}")
        decoded, ranges = self._decoded(positions, ranges, log)

        subs = routing.subscriptions(routing.destinations_frame(spark, [self.destination]))
        rejected = decode.blocked_sources(decoded).select("source_id", F.col("offset").alias("seq"), "reason").collect()  # one row per source at most
        accepted = decode.accepted_prefix(decoded, partitions) if rejected else decoded.drop("reject_reason")
        routed = routing.apply_filters(routing.route(accepted, subs))
        horizons = few_rows(spark, [(p["topic"], p["partition"], p["horizon"]) for p in positions], "topic string, partition int, horizon bigint")
        marked = routing.split_known_skips(routed, self._skips_of(ranges), horizons, partitions)
        marked = marked.withColumn("outcome", F.when(F.col("known_skip"), "skipped").otherwise(F.col("outcome")))
        # Only the first record of a partition's range can have been tried before.
        first = few_rows(spark, [(*r[:3], r[4]) for r in ranges], "topic string, partition int, offset bigint, tried bigint")
        marked = marked.join(small_side(first, len(ranges)), ["topic", "partition", "offset"], "left")
        marked = marked.withColumn("tried", F.coalesce("tried", F.lit(0)))
        requests = routing.headers(routing.envelopes(marked))
        sleep = {"sleep": self.sleep} if self.sleep else {}
        results = deliver(requests, self.sender, self.max_attempts, _TASKS_PER_PARTITION * partitions, keep=_OF_RECORD, **sleep)
        results.write.mode("overwrite").parquet(f"{round_path}/sent")
        # What was sent, with what the rest of the round needs of its record.
        sent = spark.read.parquet(f"{round_path}/sent")

        skipped = sent.filter(~F.col("known_skip") & (F.col("outcome") == "skipped"))
        if not skipped.isEmpty():
            # Skips are stored before the position passes them.
            outcomes.new_skips(self._skips_of(ranges), skipped).write.mode("append").parquet(self.path("skips"))
        self._log(sent, f"{round_path}/activity")
        if rejected:
            self._store_blocks(few_rows(spark, rejected, _BLOCKED))
        moved = self._advance(sent, state)
        if log is None:
            self._forget()
        return moved

    def _decoded(self, positions: list, ranges: list[tuple], log: DataFrame | None) -> tuple[DataFrame, list[tuple]]:
        """The round's decoded records, and its ranges, cut where what is decoded ends."""
        places = [(t, p, low) for t, p, low, *_ in ranges]
        if self._ahead is None or any(not self._ahead.reach(t, p)[0] <= low < self._ahead.reach(t, p)[1] for t, p, low in places):
            self._decode_ahead(positions, log)
        ahead = self._ahead
        ranges = [(t, p, low, min(high, ahead.reach(t, p)[1]), tried) for t, p, low, high, tried in ranges]
        found = _within(self.spark.read.schema(ahead.schema).parquet(ahead.folder), ranges)
        return segments.within_bytes(found, self.round_bytes, F.col("size")).drop("size"), ranges

    def _decode_ahead(self, positions: list, log: DataFrame | None) -> None:
        """Decode the records of the next rounds in one go, those of one round if ``log`` is not listed for several.

        At most so many rounds' records and bytes per log partition. Decoding has no effect outside; what a block
        makes useless is dropped with the rest.
        """
        self._forget()
        rounds = 1 if log is None else _ROUNDS_AHEAD
        log = self.log() if log is None else log
        ranges = [
            (p["topic"], p["partition"], p["committed"], min(p["end_offset"], p["committed"] + rounds * self.round_size), p["tried"])
            for p in positions
            if p["committed"] < p["end_offset"]
        ]
        raw = segments.within_bytes(_within(log, ranges), rounds * self.round_bytes)
        # The log may hold a record twice if its writer repeated a batch; a position counts once. The order is that of the bytes.
        before = F.lag("offset").over(Window.partitionBy("topic", "partition").orderBy("offset"))
        raw = raw.withColumn("before", before).filter(F.col("before").isNull() | (F.col("before") != F.col("offset"))).drop("before")
        # Dealt out again, so decoding is not bound to a task per log partition.
        raw = raw.withColumn("size", segments.record_bytes()).repartition("topic", "partition", F.floor(F.col("offset") / _DECODED_TOGETHER))
        raw = raw.sortWithinPartitions("topic", "partition", "offset")
        sources = [c for c in self.sources if c.topic in {r[0] for r in ranges}]
        decoded = reduce(
            DataFrame.unionByName,
            [
                decode.decode_changes(
                    raw.filter(F.col("topic") == c.topic), c.source, c.identity, self.scope.generation, ["size"]
                ).drop("row")
                for c in sources
            ],
        ).withColumn("replay", F.lit(self.replay))
        folder = self.path(f"ahead/{uuid.uuid4().hex}")
        decoded.write.parquet(folder)
        ends = log_bounds(self.spark.read.schema(decoded.schema).parquet(folder)).collect()  # one row per log partition
        ends = {(e["topic"], e["partition"]): e["end_offset"] for e in ends}
        self._ahead = _Ahead(folder, decoded.schema, {r[:2]: (r[2], ends.get(r[:2], r[3])) for r in ranges})

    def _forget(self) -> None:
        """Delete what was decoded ahead, also by a job that died."""
        self._ahead = None
        for folder in _folders(self.spark, self.path("ahead/*")):
            _delete(self.spark, folder)

    def _store_blocks(self, found: DataFrame) -> None:
        if not found.isEmpty():
            found.select("source_id", F.col("seq").cast("long").alias("seq"), "reason").write.mode("append").parquet(self.blocked_path())

    def _advance(self, sent: DataFrame, state: list) -> bool:
        """Write the positions after ``sent``; ``state``: those before it, a row per log partition like what is collected here."""
        reached = {(r["topic"], r["partition"]): r["committed"] for r in outcomes.commit_frontier(sent).collect()}
        retrying = sent.filter(F.col("outcome").isNull()).select("topic", "partition", F.element_at("attempts", -1)["attempt"].alias("last"))
        last = {(r["topic"], r["partition"]): r["last"] for r in retrying.collect()}
        moved, rows = False, []
        for p in state:
            place, row = (p["topic"], p["partition"]), p.asDict()
            # A partition without results in this round keeps what it has.
            if place in reached:
                moved |= reached[place] > p["committed"]
                row |= {"committed": max(p["committed"], reached[place]), "tried": last[place] + 1 if last.get(place) is not None else 0}
            rows.append(tuple(row[c.split()[0]] for c in _POSITIONS.split(", ")))
        tables.write_state(few_rows(self.spark, rows, _POSITIONS), self.path("positions"))
        return moved

    def _log(self, finished: DataFrame, path: str) -> None:
        records = finished.withColumn("committed", F.col("outcome").isNotNull())
        entries = activity.activity_entries(records)
        stamped = activity.stamped(entries, self.boot, activity.record_order(), self.sequence)
        # Only this round's own folder is read: what it costs does not grow with the rounds before it.
        self.sequence = max(self.sequence, self.activity_log().append(stamped.drop("step"), self.boot, path))

    def activity_log(self) -> ActivityLog:
        """The newest entries by cursor, and all of them by identifier. Lines lie in the folders of their rounds."""
        return ActivityLog(self.spark, self.path("").rstrip("/"), "rounds/*/activity")

    def activity(self) -> DataFrame:
        """The entries that this job has written in its present life; read them with ``operators.activity``."""
        return self.activity_log().history().filter(F.col("id").startswith(f"{self.boot}:"))

    def drain(self) -> None:
        """Rounds until nothing moves: the end is reached, or what is left keeps asking for a retry.

        The log's files are listed once for all of them.
        """
        log = self.log()
        try:
            while not self.paused and self.round(log):
                pass
        finally:
            self._forget()

    def process(self, batch: DataFrame, _: int) -> None:
        # One row per log partition. Also when pausing: the checkpoint passes this batch.
        seen = log_bounds(batch.filter(F.col("topic").isin(self._topics()))).collect()
        if seen:
            self._take(self._whole(seen), at_start=False)
        self.drain()
        self.compact(running=True)

    def _whole(self, seen: list) -> DataFrame:
        """Bounds of a micro-batch, with those of new partitions from the log: a batch need not begin at their start."""
        known = {(p["topic"], p["partition"]) for p in self.positions().select("topic", "partition").collect()}
        new = [s for s in seen if (s["topic"], s["partition"]) not in known]
        rows = [tuple(s) for s in seen if s not in new]
        if new:
            log = self.log().filter(F.col("topic").isin(sorted({s["topic"] for s in new})))
            log = log.filter(F.col("partition").isin(sorted({s["partition"] for s in new})))
            places = {(s["topic"], s["partition"]) for s in new}
            rows += [tuple(r) for r in log_bounds(log).collect() if (r["topic"], r["partition"]) in places]
        return self.spark.createDataFrame(rows, _BOUNDS)

    def compact(self, running: bool = False) -> None:
        """Write the outcomes of many rounds, and many small files of skips, together.

        ``running``: after a micro-batch. What was replaced then stays until the next time, for readers that have listed it; it is
        there twice meanwhile, which changes nothing, as after a crash in between.
        """
        for name, schema in (("rounds/*/sent", _SENT), ("skips", _SKIPS)):
            found = _folders(self.spark, self.path(name)) if "*" in name else _files(self.spark, self.path(name))
            old = [path for path in found if not running or path not in self._replaced]
            if len(old) > _COMPACT:
                gone = [path for path in found if path in self._replaced]
                table = _read_appended(self.spark, self.path(name), schema)
                if "*" in name:
                    table, target = tables.best_outcomes(table), self.path(f"rounds/compact-{uuid.uuid4().hex}/sent")
                else:
                    # In order, so that a round's filters prune.
                    table, target = table.distinct().repartitionByRange("topic", "partition", "offset"), self.path(name)
                    table = table.sortWithinPartitions("topic", "partition", "offset")
                table.write.mode("append").parquet(target)
                self._replaced -= set(gone)
                self._replaced |= set(old)
                for path in gone if running else old:
                    _delete(self.spark, path)

    def start(self, per_trigger: int | None = None, available_now: bool = False, every: str = "5 seconds") -> StreamingQuery:
        """Start, or go on where the checkpoint and the positions left off.

        A heartbeat keeps micro-batches coming while the log is quiet, so records that asked for a
        retry are tried again.
        """
        self.compact()
        self._take(self._bounds(), at_start=True)
        # The heartbeat is part of bounded runs too: a checkpoint is tied to its sources.
        stream = read_changes_stream(
            self.spark, self.log_path, per_trigger, self.log_format, **self.log_options
        ).unionByName(_heartbeat(self.spark))
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", self.path("checkpoint"))
        return writer.trigger(**trigger).start()

    def outcomes(self) -> DataFrame:
        """Latest outcome per position over all rounds. Retried positions appear in several rounds."""
        return tables.best_outcomes(_read_appended(self.spark, self.path("rounds/*/sent"), _SENT))


def _heartbeat(spark: SparkSession) -> DataFrame:
    """One record without a topic per second."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beats.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_RECORD.fields])


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    fs, target = tables.hadoop_path(spark, pattern)
    return [str(f.getPath()) for f in fs.globStatus(target) or []]


def _files(spark: SparkSession, path: str) -> list[str]:
    return _folders(spark, f"{path}/*.parquet")


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, and the folder above if nothing else is in it."""
    fs, target = tables.hadoop_path(spark, path)
    fs.delete(target, True)
    above = target.getParent()
    if fs.exists(above) and not len(fs.listStatus(above)):
        fs.delete(above, False)


def _read_appended(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """An appended table, or an empty one before its first write."""
    fs, target = tables.hadoop_path(spark, path)
    found = fs.globStatus(target)
    if found is None or len(found) == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def start_delivery(job: DeliveryJob, desired: str = "running", **options) -> StreamingQuery | None:
    """Start one destination's query, or leave it stopped while it is paused.

    A paused destination keeps its positions and checkpoint, so a later start loses nothing.
    """
    return apply_desired(None, job, desired, **options)


def apply_desired(
    query: StreamingQuery | None, job: DeliveryJob, desired: str, drain_timeout: float = 30.0, **options
) -> StreamingQuery | None:
    """Bring a query in line with the desired state: stop it on pause, start it again on running.

    A pause lets the current round finish for ``drain_timeout`` seconds; a round cut off after that is
    sent again on resume.
    """
    active = query is not None and query.isActive
    job.paused = desired == "paused"
    if not job.paused:
        return query if active else job.start(**options)
    if active:
        deadline = time.monotonic() + drain_timeout
        while query.status["isTriggerActive"] and time.monotonic() < deadline:
            time.sleep(0.1)
        query.stop()
    return None
