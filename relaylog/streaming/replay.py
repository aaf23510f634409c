"""Replay: a destination's records once more, into a fresh target, from recorded positions.

A replay has positions, skips, outcomes and activity of its own, below a group of its own, so normal delivery is never
touched. Its creation checks the sources' identities and the retained history, and records a start and an exclusive end
per log partition before anything is sent. A bounded replay stops at these ends; one that follows goes on with new
records after it has reached them. Requests say so in their replay header.

Its state is stored, so it survives restarts:

    created -> running -> completed | following
    running, following -> paused -> running, following
    any of these -> blocked (history lost, or a record that can't be decoded), cancelled

``completed``, ``blocked`` and ``cancelled`` are final. A record that keeps asking for a retry leaves the replay
running; the next ``run`` goes on with it. What blocks a replay does not block the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relaylog.functions.keys import delivery_group
from relaylog.model import ConfigError, Identity
from relaylog.operators import outcomes, tables
from relaylog.operators.scale import small_side
from relaylog.sources.changes import log_bounds, read_changes_stream
from relaylog.streaming.delivery import DeliveryJob, HistoryLost

_PLAN = "topic string, partition int, start bigint, boundary bigint"
_STATUS = "state string, reason string, follow boolean, revision string, identities string"
_FINAL = ("completed", "blocked", "cancelled")
_MOVES = {
    "created": ("running", "paused", "blocked", "cancelled"),
    "running": ("following", "completed", "paused", "blocked", "cancelled"),
    "following": ("paused", "blocked", "cancelled"),
    "paused": ("running", "following", "blocked", "cancelled"),
}


class ReplayRefused(RuntimeError):
    """A replay that may not be created, or may not go on from its state."""


def replay_records(records: DataFrame, ranges: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    """Decoded records of ``ranges`` (topic, partition, start, exclusive end) as records of a replay.

    One range per log partition; partitions without one are not replayed.
    """
    spark = records.sparkSession
    wanted = small_side(spark.createDataFrame(list(ranges), _PLAN), len(ranges))
    near = records.filter((F.col("offset") >= min(r[2] for r in ranges)) & (F.col("offset") < max(r[3] for r in ranges))) if ranges else records
    found = near.drop("replay").join(wanted, ["topic", "partition"]).filter("offset >= start and offset < boundary")
    return found.drop("start", "boundary").withColumn("replay", F.lit(True))


def _described(identity: Identity) -> str:
    columns = ",".join(f"{c.name}:{c.type}" for c in identity.columns)
    return f"{identity.table}|{identity.serial_column}|{identity.partitioning_column}|{identity.partitions}|{columns}"


@dataclass
class ReplayJob(DeliveryJob):
    """``DeliveryJob`` over recorded ranges. ``sender`` is that of the replay's target."""

    replay_id: str = ""
    replay: bool = True

    def __post_init__(self):
        if not self.replay_id or "/" in self.replay_id:
            raise ConfigError("a replay needs an id without slashes")

    def path(self, name: str) -> str:
        return f"{self.state_path}/{delivery_group(self.scope, self.destination.id)}.replay.{self.replay_id}/{name}"

    # -- life cycle -------------------------------------------------------------------------------------------------

    def status(self) -> dict | None:
        """state, reason, follow, revision; none before it is created."""
        row = tables.read_state(self.spark, self.path("status"), _STATUS).first()
        return None if row is None else row.asDict()

    def plan(self) -> DataFrame:
        """topic, partition, start and boundary, as recorded at creation."""
        return tables.read_state(self.spark, self.path("plan"), _PLAN)

    def _identities(self) -> str:
        return "\n".join(sorted(f"{c.source.id}|{c.topic}|{_described(c.identity)}" for c in self.sources))

    def create(
        self,
        starts: Mapping[tuple[str, int], int] | None = None,
        ends: Mapping[tuple[str, int], int] | None = None,
        follow: bool = False,
        fresh_target: bool = False,
        revision: str = "",
    ) -> None:
        """Record the ranges; by default all that the log holds now.

        ``starts`` and ``ends`` (exclusive): offsets by (topic, partition). ``fresh_target`` declares that the target is empty.
        """
        if not fresh_target:
            raise ReplayRefused("the target of a replay must be declared fresh")
        if self.status() is not None:
            raise ReplayRefused(f"replay {self.replay_id} exists")
        # One row per log partition of this generation.
        bounds = {(b["topic"], b["partition"]): (b["first_offset"], b["end_offset"]) for b in self._bounds().collect()}
        rows = []
        for place in sorted({*bounds, *(starts or {}), *(ends or {})}):
            if place not in bounds:
                raise ReplayRefused(f"{place[0]}/{place[1]} is not in the log")
            first, end = bounds[place]
            start, boundary = (starts or {}).get(place, first), (ends or {}).get(place, end)
            if not first <= start <= boundary <= end:
                raise ReplayRefused(f"{place[0]}/{place[1]}: {start} to {boundary} is not within the log's {first} to {end}")
            rows.append((*place, start, boundary))
        plan = self.spark.createDataFrame(rows, _PLAN)
        tables.write_state(plan, self.path("plan"))
        # A record of a replay has no stored skip: what was skipped before may be wanted by a fresh target.
        positions = plan.select(
            "topic", "partition", F.col("start").alias("first_offset"), F.col("boundary").alias("end_offset"),
            F.lit(0).cast("long").alias("horizon"), F.col("start").alias("committed"), F.lit(0).cast("long").alias("tried"),
        )
        tables.write_state(positions, self.path("positions"))
        self._write_status({"state": "created", "reason": None, "follow": follow, "revision": revision, "identities": self._identities()})

    def _write_status(self, status: dict) -> None:
        tables.write_state(self.spark.createDataFrame([tuple(status[c.split()[0]] for c in _STATUS.split(", "))], _STATUS), self.path("status"))

    def _move(self, state: str, reason: str | None = None) -> None:
        status = self.status()
        if status is None:
            raise ReplayRefused(f"replay {self.replay_id} was not created")
        if status["state"] == state:
            return
        if state not in _MOVES.get(status["state"], ()):
            raise ReplayRefused(f"replay {self.replay_id} is {status['state']} and can't become {state}")
        self._write_status({**status, "state": state, "reason": reason})

    def cancel(self) -> None:
        self._move("cancelled")

    def pause(self) -> None:
        self.paused = True
        self._move("paused")

    def _block(self, reason: str) -> None:
        self._move("blocked", reason)

    # -- work -------------------------------------------------------------------------------------------------------

    def down(self) -> list[str]:
        """A replay rests for its own state only."""
        status = self.status()
        return [] if status and status["state"] in ("running", "following") else [self.replay_id]

    def _store_blocks(self, found: DataFrame) -> None:
        blocked = found.orderBy("source_id", "seq").first()  # the first of at most one row per source
        if blocked is not None:
            self._block(f"{blocked['source_id']}: {blocked['reason']}")

    def _open(self) -> None:
        """Go on from the stored state: not after its end, not with other identities, not where history is lost."""
        status = self.status()
        if status is None:
            raise ReplayRefused(f"replay {self.replay_id} was not created")
        if status["state"] in _FINAL:
            raise ReplayRefused(f"replay {self.replay_id} is {status['state']}")
        if status["identities"] != self._identities():
            self._block("the sources are not those that the replay was created for")
            raise ReplayRefused("the sources are not those that the replay was created for")
        positions = self.positions()
        bounds = positions.select("topic", "partition", "committed").join(self._bounds(), ["topic", "partition"], "left")
        inside = F.col("committed").between(F.col("first_offset"), F.col("end_offset"))
        lost = bounds.filter(~F.coalesce(inside, F.lit(False))).collect()  # one row per log partition at most
        if lost:
            self._block(outcomes.OUT_OF_RANGE)
            raise HistoryLost("; ".join(f"{r['topic']}/{r['partition']}: {outcomes.OUT_OF_RANGE}" for r in lost))
        self.paused = False
        self._move("following" if status["follow"] and self._reached() else "running")

    def _reached(self) -> bool:
        """Is every recorded boundary behind?"""
        open_ = self.positions().join(self.plan(), ["topic", "partition"]).filter(F.col("committed") < F.col("boundary"))
        return open_.isEmpty()

    def _settle(self) -> None:
        status = self.status()
        if status["state"] == "running" and self._reached():
            self._move("following" if status["follow"] else "completed")

    def run(self) -> str:
        """Work until the boundaries are reached or nothing moves; the state then. Can be called again."""
        self._open()
        self.drain()
        self._settle()
        return self.status()["state"]

    def process(self, batch: DataFrame, _: int) -> None:
        seen = log_bounds(batch.filter(F.col("topic").isin(self._topics()))).collect()  # one row per log partition
        # A partition that the log did not have at creation is followed from its start.
        new = self._whole(seen).select("topic", "partition", F.col("first_offset").alias("new_first"), F.col("end_offset").alias("seen"))
        joined = self.positions().join(new, ["topic", "partition"], "full_outer")
        state = joined.select(
            "topic", "partition", F.coalesce("first_offset", "new_first").alias("first_offset"),
            F.greatest("end_offset", "seen").alias("end_offset"), F.coalesce("horizon", F.lit(0)).alias("horizon"),
            F.coalesce("committed", "new_first").alias("committed"), F.coalesce("tried", F.lit(0)).alias("tried"),
        )
        tables.write_state(state, self.path("positions"))
        self.drain()
        self._settle()

    def start(self, per_trigger: int | None = None, available_now: bool = False, every: str = "5 seconds") -> StreamingQuery:
        """Follow the log: first what is left up to the boundaries, then new records as they come."""
        status = self.status()
        if status is None or not status["follow"]:
            raise ReplayRefused("a bounded replay is run, not started")
        self._open()
        stream = read_changes_stream(self.spark, self.log_path, per_trigger, self.log_format, **self.log_options)
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return stream.writeStream.foreachBatch(self.process).option("checkpointLocation", self.path("checkpoint")).trigger(**trigger).start()
