"""Ordered push of records through a pluggable sender."""

from __future__ import annotations

import base64
import http.client
import json
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.functions.acks import INVALID_ACK, MAX_RESPONSE_BYTES, RETRY_REQUESTED, TOO_LARGE
from relaylog.operators.outcomes import RECORD_KEY

#: (body, headers) -> (status, body). Bytes are taken as they came, so their size is the size that was sent.
Sender = Callable[[str, dict], tuple[int | None, str | bytes]]

#: How deep a response may be nested. The JSON reader of the batch side stops there too; beyond it a response is a retry.
MAX_DEPTH = 999

_ATTEMPTS = "array<struct<attempt: int, status: int, outcome: string, retry_reason: string>>"
DELIVERY_SCHEMA = (
    f"destination_id string, topic string, partition int, offset bigint, outcome string, attempts {_ATTEMPTS}"
)


def _reject_constant(_: str):
    raise ValueError


class _Pairs(list):
    """A JSON object as its members, in order and with duplicates."""


def _members(obj: _Pairs, name: str, any_case: bool = False) -> list:
    return [v for k, v in obj if (k.lower() if any_case else k) == name]


_BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"?|[\[\]{}]')


def _depth(body: str) -> int:
    depth = deepest = 0
    for m in _BRACKETS.finditer(body):
        if m[0] in "[{":
            depth += 1
            deepest = max(deepest, depth)
        elif m[0] in "]}":
            depth -= 1
    return deepest


def _ack(body: str) -> str | None:
    """One body's acknowledgement; the same rules as ``functions.acks.decode_ack``."""
    if _depth(body) > MAX_DEPTH:
        return None
    number = {"parse_int": len, "parse_float": len}  # values of numbers don't matter, and may be too long to read
    try:
        document = json.loads(body, object_pairs_hook=_Pairs, parse_constant=_reject_constant, **number)
    except (ValueError, RecursionError):
        return None
    results = _members(document, "result", any_case=True) if isinstance(document, _Pairs) else []
    if len(results) != 1 or not isinstance(results[0], _Pairs):
        return None
    success, error = _members(results[0], "success"), _members(results[0], "error")
    if success and isinstance(success[-1], _Pairs):
        return "success"
    if not error or not isinstance(error[-1], _Pairs):
        return None
    fields = []
    for name in ("policy", "class", "description"):
        values = _members(error[-1], name, any_case=True)
        if not values or values[-1] is None or any(v is not None and not isinstance(v, str) for v in values):
            return None
        fields.append(values[-1])
    return {"keep_going": "keep_going", "must_retry": "retry"}.get(fields[0])


def classify(status: int | None, body: str | bytes) -> tuple[str | None, str | None]:
    """One response's (outcome, retry reason); the same rules as ``classify_response``."""
    if status is None:
        return None, "destination unreachable"
    raw = body.encode() if isinstance(body, str) else body
    if len(raw) > MAX_RESPONSE_BYTES:
        return None, TOO_LARGE
    if not 200 <= status <= 299:
        return None, f"destination returned HTTP {status}"
    ack = _ack(raw.decode("utf-8", "replace"))
    if ack == "success":
        return "delivered", None
    if ack == "keep_going":
        return "skipped", None
    return None, INVALID_ACK if ack is None else RETRY_REQUESTED


def _backoff(attempt: int) -> float:
    half = 2.0 ** min(attempt, 6) / 2
    return min(max(half + random.random() * half, 1.0), 60.0)


def deliver(
    routed: DataFrame,
    sender: Sender,
    max_attempts: int,
    parallelism: int,
    sleep: Callable[[float], None] = time.sleep,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Send records in offset order per (destination, topic, partition), log partitions in parallel.

    ``routed`` carries ``body``, ``headers`` and ``outcome`` (a filtered record is finished and not
    sent). A partition stops at the first record still retrying after ``max_attempts``; that record
    comes back without an outcome, those behind it do not come back at all, and both stay pending. A column
    ``tried`` (attempts in earlier calls, else null) lets attempt numbers and waits go on from there. Columns to ``keep``
    come back beside the outcome, so that it need not be joined to the record again.

    Sending is a side effect: write the result once and read it from there. Order allows one task per
    log partition, so a task streams its rows and holds one Arrow batch; bound a round by offsets
    (``streaming.delivery``) and add log partitions for more parallelism. The explicit partition count
    keeps AQE from merging log partitions into one task.
    """
    key = ["destination_id", "topic", "partition"]

    names = [*RECORD_KEY, "outcome", "tried", "body", "headers"]

    def send_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stopped = set()
        for batch in batches:
            places, outcomes, tries = [], [], []
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            for i, (destination, topic, partition, _, outcome, number, body, headers) in enumerate(zip(*[c.to_pylist() for c in columns], strict=True)):
                place = (destination, topic, partition)
                if place in stopped:
                    continue
                attempts = []
                while outcome is None and len(attempts) < max_attempts:
                    if number:
                        sleep(_backoff(number - 1))
                    status, answer = sender(body, dict(headers))
                    outcome, reason = classify(status, answer)
                    attempts.append({"attempt": number, "status": status, "outcome": outcome, "retry_reason": reason})
                    number += 1
                if outcome is None and partition is not None:  # without a log partition there is no order to keep
                    stopped.add(place)
                places.append(i)
                outcomes.append(outcome)
                tries.append(attempts)
            at, text = pa.array(places, pa.int64()), columns[len(RECORD_KEY)].type
            attempt = pa.struct([("attempt", pa.int32()), ("status", pa.int32()), ("outcome", text), ("retry_reason", text)])
            kept = {f"kept_{i}": batch.column(batch.schema.get_field_index(f"kept_{i}")).take(at) for i in range(len(keep))}
            key = {n: c.take(at) for n, c in zip(RECORD_KEY, columns, strict=False)}
            found = {**key, "outcome": pa.array(outcomes, text), "attempts": pa.array(tries, pa.list_(attempt)), **kept}
            yield pa.RecordBatch.from_arrays([*found.values()], names=[*found])

    tried = F.coalesce("tried", F.lit(0)) if "tried" in routed.columns else F.lit(0)
    due = F.col("outcome").isNull()  # what is finished needs no request
    ordered = (
        routed.select(
            *RECORD_KEY, "outcome", F.when(due, F.col("body")).alias("body"), F.when(due, F.col("headers")).alias("headers"), tried.cast("long").alias("tried"),
            *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)],
        )
        .repartition(parallelism, *[F.col(k) for k in key])
        .sortWithinPartitions(*RECORD_KEY)
    )
    beside = "".join(f", kept_{i} {routed.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    return ordered.mapInArrow(send_all, DELIVERY_SCHEMA + beside).withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def http_sender(
    endpoint: str, username: str, password: str, timeout: float = 60.0, opener: urllib.request.OpenerDirector | None = None
) -> Sender:
    """POST with Basic auth and JSON; redirects are not followed, at most one byte over the limit is read."""
    token = base64.b64encode(f"{username}:{password}".encode()).decode()

    def send(body: str, headers: dict) -> tuple[int | None, bytes]:
        request = urllib.request.Request(
            endpoint, body.encode(), {**headers, "Authorization": f"Basic {token}"}, method="POST"
        )
        try:
            with (opener or urllib.request.build_opener(_NoRedirect)).open(request, timeout=timeout) as response:
                return response.status, response.read(MAX_RESPONSE_BYTES + 1)
        except urllib.error.HTTPError as e:
            try:
                with e:
                    return e.code, e.read(MAX_RESPONSE_BYTES + 1)
            except (OSError, http.client.HTTPException):
                return None, b""
        except (OSError, http.client.HTTPException):
            return None, b""

    return send
