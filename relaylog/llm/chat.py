"""Tool calls in conversations: linked to their results, put in an order that respects them, checked and serialised.

A message is a row with conv_id, turn, role, text, ``calls`` (id, name and JSON arguments of each), ``result_of`` (the id
of the call that it answers) and ``after`` (the id of a call whose result it needs). Calls and results meet in a hash
join on (conv_id, id): the first call and the first result of an id count, in order of turn, and the others are reported
as repeated. A message depends on one other: a result on its call, any other on the result of ``after`` or, while that
has none, on the call. Following these links by doubling gives every message the latest turn among what it depends on
and its depth; ordered by (sort_turn, depth, turn) every message stands after what it depends on, and otherwise turns
stay as they are. Messages that depend on themselves keep their turn and are reported.

Arguments are checked against the tools' schemas (a subset of JSON Schema) and the message is written as canonical
JSON: keys in order, no spaces, numbers in shortest form. A conversation is never gathered in one task; the result has
one row for each message.

Null conv_ids and ids link with nothing. A null text is null in the JSON. A null turn counts as 0. Arguments that are
no JSON object stand as text and are reported. Rows that repeat are messages of their own. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import map_batches, row_numbers, stored

CALLS = "array<struct<id:string,name:string,arguments:string>>"
_TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "number": (int, float), "integer": int,
}


def _is(value: object, kind: str) -> bool:
    if isinstance(value, bool) and kind in ("number", "integer"):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def schema_error(value: object, schema: Mapping, at: str = "$") -> str | None:
    """What is first wrong with a JSON value, or None.

    Known: type, enum, required, properties, additionalProperties (false), items, minimum, maximum, minLength, maxLength.
    """
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: not of type {kinds}"
    if "enum" in schema and not any(value == x and isinstance(value, bool) == isinstance(x, bool) for x in schema["enum"]):
        return f"{at}: not in the list"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            return f"{at}: out of range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        return f"{at}: wrong length"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{at}: {name} is missing"
        for name in sorted(value):
            if name in known:
                if error := schema_error(value[name], known[name], f"{at}.{name}"):
                    return error
            elif schema.get("additionalProperties") is False:
                return f"{at}: {name} is unknown"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if error := schema_error(item, schema["items"], f"{at}[{i}]"):
                return error
    return None


def _plain_numbers(value: object) -> object:
    """Whole floats as integers, as canonical JSON has one form for each number."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        return int(value)
    if isinstance(value, list):
        return [_plain_numbers(x) for x in value]
    if isinstance(value, dict):
        return {k: _plain_numbers(x) for k, x in value.items()}
    return value


def canonical(value: object) -> str:
    return json.dumps(_plain_numbers(value), ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))


def _refuse(constant: str) -> None:
    raise ValueError(constant)


def parsed_arguments(text: str | None, name: str | None, schemas: Mapping[str, Mapping]) -> tuple[object, str | None]:
    """The arguments of a call and what is wrong with them."""
    try:
        value = json.loads(text if text is not None else "", parse_constant=_refuse)
        canonical(value)
    except (ValueError, RecursionError):
        return text, "arguments are no JSON"
    if not isinstance(value, dict):
        return text, "arguments are no object"
    if name not in schemas:
        return value, "unknown tool"
    return value, schema_error(value, schemas[name])


def _messages(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """A stored row for each message with its ids, errors and canonical JSON."""
    numbers = {"next": 0}

    def rows(batch: pa.RecordBatch) -> dict:
        first, numbers["next"] = numbers["next"], numbers["next"] + batch.num_rows
        ids, errors, lines = [], [], []
        for m in batch.to_pylist():
            calls, wrong = [], []
            for call in m["calls"] or []:
                arguments, error = parsed_arguments(call["arguments"], call["name"], schemas)
                calls.append({"id": call["id"], "name": call["name"], "arguments": arguments})
                if error:
                    wrong.append(f"{call['id']}: {error}")
            message = {"role": m["role"], "content": m["text"]}
            if calls:
                message["calls"] = calls
            if m["result_of"] is not None:
                message["result_of"] = m["result_of"]
            ids.append([c["id"] for c in calls])
            errors.append("; ".join(wrong))
            lines.append(canonical(message))
        columns = {n: batch.column(n) for n in ("conv_id", "turn", "role", "result_of", "after")}
        return {"row": row_numbers(first, batch.num_rows), **columns, "call_ids": ids, "errors": errors, "message": lines}

    source = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        "role", "text", F.col("calls").cast(CALLS).alias("calls"), "result_of", "after",
    )
    schema = "row long, conv_id long, turn long, role string, result_of string, after string, call_ids array<string>, errors string, message string"
    return stored(map_batches(source, rows, schema), "messages")


def _ordered(linked: DataFrame) -> DataFrame:
    """row, sort_turn, depth and whether it is in or behind a cycle, from row, conv_id, turn and parent."""
    largest = linked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    first = F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")
    state = stored(linked.select("row", F.col("parent").alias("up"), F.col("turn").alias("best"), first), "order")
    # Rows that have reached their first ancestor are set aside, so a round handles only chains that are still longer.
    done, still = state.filter("up is null"), state.filter("up is not null")
    for _ in range(largest.bit_length() + 1):
        if not still.limit(1).count():
            break
        known = done.unionByName(still)
        above = known.select(F.col("row").alias("at"), F.col("up").alias("up2"), F.col("best").alias("best2"), F.col("depth").alias("depth2"))
        joined = still.join(above, F.col("up") == F.col("at"), "left")
        best = F.greatest("best", F.coalesce("best2", "best")).alias("best")
        # Along a cycle depths double with every round, and mean nothing.
        now = stored(joined.select("row", F.col("up2").alias("up"), best, (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")), "order")
        done, still = done.unionByName(now.filter("up is null")), now.filter("up is not null")
    state = done.unionByName(still)
    return state.select("row", F.col("up").isNotNull().alias("cyclic"), F.col("best").alias("sort_turn"), "depth")


def link_calls(messages: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """A row for each message: its order, how its result is linked, its calls without result, errors, canonical JSON."""
    rows = _messages(messages, schemas)
    order = F.struct("turn", "row")
    calls = rows.select("conv_id", "turn", "row", F.explode("call_ids").alias("id")).filter("id is not null and conv_id is not null")
    first_call = calls.groupBy("conv_id", "id").agg(F.min(order).alias("call"))
    first_call = first_call.select(F.col("conv_id").alias("c_conv"), F.col("id").alias("c_id"), F.col("call.row").alias("call_row"))
    results = rows.filter("result_of is not null and conv_id is not null")
    first_result = results.groupBy("conv_id", "result_of").agg(F.min(order).alias("result"))
    first_result = first_result.select(F.col("conv_id").alias("r_conv"), F.col("result_of").alias("r_id"), F.col("result.row").alias("result_row"))
    links = stored(first_call.join(first_result, (F.col("c_conv") == F.col("r_conv")) & (F.col("c_id") == F.col("r_id")), "full"), "links")
    by_id = links.select(F.coalesce("c_conv", "r_conv").alias("l_conv"), F.coalesce("c_id", "r_id").alias("l_id"), "call_row", "result_row")

    needs = F.coalesce("result_of", "after")
    joined = rows.join(by_id, (F.col("conv_id") == F.col("l_conv")) & (needs == F.col("l_id")), "left")
    is_result = F.col("result_of").isNotNull()
    parent = F.when(is_result, F.col("call_row")).otherwise(F.coalesce("result_row", "call_row"))
    status = (
        F.when(~is_result, F.lit(None))
        .when(F.col("call_row").isNull(), "without call")
        .when(F.col("result_row") != F.col("row"), "repeated")
        .otherwise("linked")
    )
    linked = joined.withColumn("parent", F.when(parent != F.col("row"), parent)).withColumn("result", status)

    open_calls = calls.join(by_id, (F.col("conv_id") == F.col("l_conv")) & (F.col("id") == F.col("l_id")))
    counted = open_calls.groupBy("row").agg(
        F.count(F.when(F.col("result_row").isNull(), 1)).alias("n_unanswered"),
        F.count(F.when(F.col("call_row") != F.col("row"), 1)).alias("n_repeated"),
    )
    done = linked.join(_ordered(linked), "row").join(counted, "row", "left")
    return done.select(
        "conv_id",
        "turn",
        F.when(F.col("cyclic"), F.col("turn")).otherwise(F.col("sort_turn")).alias("sort_turn"),
        F.when(F.col("cyclic"), F.lit(0)).otherwise(F.col("depth")).cast("long").alias("depth"),
        "cyclic",
        "role",
        "result",
        F.size("call_ids").cast("long").alias("n_calls"),
        F.coalesce("n_unanswered", F.lit(0)).cast("long").alias("n_unanswered"),
        F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated"),
        "errors",
        "message",
    )


#: The schema of the calls that ``turns_as_calls`` derives.
ASK = {
    "ask": {
        "type": "object",
        "required": ["question", "words"],
        "properties": {"question": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1, "maximum": 40}},
        "additionalProperties": False,
    }
}


def turns_as_calls(conversations: DataFrame) -> DataFrame:
    """Messages from a table of plain turns: each user turn is a call, each assistant turn the result of the turn before.

    The id of a call is its turn; a call needs the result of the user turn before it.
    """
    turn, user, reply = F.col("turn"), F.col("role") == "user", F.col("role") == "assistant"
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    arguments = F.to_json(F.struct(words.alias("words"), F.col("text").alias("question")))
    call = F.struct(F.concat(F.lit("t"), turn).alias("id"), F.lit("ask").alias("name"), arguments.alias("arguments"))
    return conversations.select(
        "conv_id",
        "turn",
        "role",
        F.when(~user, F.col("text")).alias("text"),
        F.when(user, F.array(call)).alias("calls"),
        F.when(reply, F.concat(F.lit("t"), turn - 1)).alias("result_of"),
        F.when(user, F.concat(F.lit("t"), turn - 2)).alias("after"),
    )
