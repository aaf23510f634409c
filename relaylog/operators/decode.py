"""Raw change records to typed records, or one fixed reject reason per record.

Rules run in a fixed order and the first that fails names the reason. Reasons name columns, never
values. All of it is built-in functions, a few steps per row: no shuffle, no Python worker.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylog.functions import jsontext as J
from relaylog.functions import values as V
from relaylog.model import Identity, Source
from relaylog.operators.scale import small_side

RECORD_COLUMNS = [
    "source_id",
    "source_description",
    "topic",
    "partition",
    "offset",
    "event_id",
    "aggregate_id",
    "event_name",
    "generation",
    "replay",
]


def _reasons(rules: list[tuple[Column, Column | str]]) -> Column:
    """The reason of the first rule that is broken, else null."""
    return F.coalesce(*[F.when(broken, _text(r)) for broken, r in rules])


def _text(reason: Column | str) -> Column:
    return F.concat(F.lit("payload: "), F.lit(reason) if isinstance(reason, str) else reason)


def _not_string(value: Column) -> Column:
    # A JSON null reads as an empty string here and fails the comparison that follows instead.
    return value.isNotNull() & ~J.is_string(value) & ~J.is_null(value)


def _differs(value: Column, wanted: str) -> Column:
    return F.coalesce(value != wanted + J.MARK, F.lit(True))


def _step(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Compute ``columns`` once per row. ``inline`` ends the reach of the optimizer's inlining.

    A filter on the reject reason would otherwise be pushed below the projections, and every
    reference to a parsed text would become a parse of its own. The work itself stays in a
    projection, which is compiled; the generator only takes the struct apart.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()]).alias("step")
    return df.select(*keep, row).select(*keep, F.inline(F.array("step")))


_RAW = ["topic", "partition", "offset", "no_value", "no_key"]
_POSITION = ["source_id", *_RAW]


def _parse(raw: DataFrame, source: Source, identity: Identity, keep: Sequence[str] = ()) -> DataFrame:
    """Each JSON text is marked and read once; members stay marked text."""
    texts = raw.select(
        *keep,
        "topic",
        "partition",
        "offset",
        (F.coalesce(F.length("value"), F.lit(0)) == 0).alias("no_value"),
        (F.coalesce(F.length("key"), F.lit(0)) == 0).alias("no_key"),
        "key",
        "value",
    )
    read = _step(
        texts,
        [*_RAW, *keep],
        # Through the generator it is a column: as a constant it would turn the join with the
        # subscriptions into a nested loop.
        source_id=F.lit(source.id),
        value=J.parse_single_object(J.mark_scalars(F.col("value")), ["op", "source", "after"]),
        key=J.parse_object_members(F.col("key")),
    )
    outer = read.select(
        *_POSITION,
        *keep,
        J.single_object(F.col("value")).alias("envelope"),
        J.object_members(F.col("key")).alias("key"),
    )
    envelope = F.col("envelope")
    meta, after = J.member(envelope, "source"), J.member(envelope, "after")
    return _step(
        outer,
        [*_POSITION, *keep],
        is_envelope=envelope.isNotNull(),
        op=J.member(envelope, "op"),
        source_text=meta,
        source=J.parse_members(J.as_object(meta), ["schema", "table"]),
        after_text=after,
        after=J.parse_members(J.as_object(after), [c.name for c in identity.columns]),
        key=F.col("key"),
    )


def _convert(parsed: DataFrame, identity: Identity) -> DataFrame:
    """Wire text per configured column, and the same for the key's value."""
    key_values = F.map_values("key")
    keyed = parsed.withColumns(
        {"key_names": F.array_distinct(F.map_keys("key")), "key_value": F.get(key_values, F.size(key_values) - 1)}
    )
    key_type = identity.column(identity.partitioning_column).type
    wire = [V.wire_value(c.type, J.member(F.col("after"), c.name)).alias(c.name) for c in identity.columns]
    return _step(keyed, keyed.columns, wire=F.struct(*wire), key_wire=V.wire_value(key_type, F.col("key_value")))


def _gate_rules(source: Source, identity: Identity) -> list[tuple[Column, Column | str]]:
    op, source_text, meta, after_text = F.col("op"), F.col("source_text"), F.col("source"), F.col("after_text")
    schema, table = J.member(meta, "schema"), J.member(meta, "table")
    key_column = identity.partitioning_column
    key_type = identity.column(key_column).type
    key_value, after_value = F.col("key_value"), J.member(F.col("after"), key_column)
    has_key_column = F.array_contains("key_names", key_column + J.MARK)

    def null_or_missing(value: Column) -> Column:
        return value.isNull() | J.is_null(value)

    # The reasons, in the order of the checks; operators of a deployment see them as block reasons.
    return [
        (F.col("no_value"), "envelope is empty"),
        (~F.col("is_envelope"), "envelope is not a JSON object"),
        (op.isNull(), 'envelope is missing "op"'),
        (_not_string(op), 'field "envelope.op" is not a string'),
        (~op.isin("c|", "r|"), "unsupported operation"),
        (source_text.isNull(), "envelope is missing source metadata"),
        (meta.isNull(), "source metadata is not a JSON object"),
        (schema.isNull(), 'source metadata is missing "schema"'),
        (_not_string(schema), 'field "source metadata.schema" is not a string'),
        (table.isNull(), 'source metadata is missing "table"'),
        (_not_string(table), 'field "source metadata.table" is not a string'),
        (_differs(schema, "public"), "source schema is not public"),
        (_differs(table, source.table), "source table does not match configured table"),
        (null_or_missing(after_text), "operation has no after object"),
        (F.col("after").isNull(), "after is not a JSON object"),
        (F.col("no_key"), "Kafka key is empty"),
        (F.col("key").isNull(), "Kafka key is not a JSON object"),
        (F.size("key_names") != 1, "Kafka key must contain only the partition column"),
        (~has_key_column | J.is_null(key_value), "Kafka key is missing the partition column"),
        (null_or_missing(after_value), "after object has a null partition column"),
        (F.col("key_wire").isNull(), V.invalid_reason(key_type, key_value, f"{key_column} in Kafka key")),
        (key_value != after_value, "Kafka key does not match the partition column"),
    ]


def _column_rules(identity: Identity) -> list[tuple[Column, Column | str]]:
    # Fixed values, as above.
    rules: list[tuple[Column, Column | str]] = []
    for c in identity.columns:
        value, wire = J.member(F.col("after"), c.name), F.col("wire").getField(c.name)
        rules.append((value.isNull(), f'after object is missing configured column "{c.name}"'))
        if c.name in (identity.serial_column, identity.partitioning_column):
            rules.append((J.is_null(value), f'required column "{c.name}" is null'))
        rules.append((~J.is_null(value) & wire.isNull(), V.invalid_reason(c.type, value, c.name)))
        if c.name == identity.event_id_column:
            rules.append((J.is_null(value), f'event id column "{c.name}" is null'))
            rules.append((~J.is_string(value), f'field "event id {c.name}" is not a string'))
            rules.append((value == J.MARK, f'event id column "{c.name}" is empty'))
    return rules


def _payload(identity: Identity) -> Column:
    """The configured columns as one JSON object; numbers and booleans are spliced in as literals."""
    wire = F.col("wire")
    texts = [c for c in identity.columns if c.type in V.STRING_TYPES]
    literals = [c for c in identity.columns if c.type not in V.STRING_TYPES]
    quoted = F.to_json(F.struct(*[wire.getField(c.name).alias(c.name) for c in texts]), {"ignoreNullFields": "false"})
    parts: list[Column] = [F.substr(quoted, F.lit(2), F.length(quoted) - 2)] if texts else []
    for c in literals:
        name = F.lit(json.dumps(c.name, ensure_ascii=False) + ":")
        parts.append(F.concat(name, F.coalesce(wire.getField(c.name), F.lit("null"))))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _string_members(identity: Identity) -> Column:
    """Map of the payload members that are JSON strings, for filters and lookups."""
    texts = [c for c in identity.columns if c.type in V.STRING_TYPES]
    if not texts:
        return F.lit(None).cast("map<string,string>")
    pairs = reduce(lambda acc, c: [*acc, F.lit(c.name), F.col("wire").getField(c.name)], texts, [])
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def decode_changes(raw: DataFrame, source: Source, identity: Identity, generation: int, keep: Sequence[str] = ()) -> DataFrame:
    """Raw records of one source -> position, identifiers, ``row`` (typed), ``payload``, ``reject_reason``.

    Exactly one row out per row in; ``reject_reason`` is null for accepted records. ``keep``: further columns of ``raw``.
    """
    identity.check(source, generation)
    checked = _convert(_parse(raw, source, identity, keep), identity).withColumn(
        "reject_reason", _reasons(_gate_rules(source, identity) + _column_rules(identity))
    )
    wire = F.col("wire")
    typed = F.struct(*[V.typed_value(c.type, wire.getField(c.name)).alias(c.name) for c in identity.columns])
    types = {c.name: c.type for c in identity.columns}

    def identifier(name: str) -> Column:
        if not name or types.get(name) not in V.STRING_TYPES:
            return F.lit("")
        return F.coalesce(wire.getField(name), F.lit(""))

    accepted = F.col("reject_reason").isNull()
    return checked.select(
        "source_id",
        F.lit(source.description).alias("source_description"),
        "topic",
        "partition",
        "offset",
        identifier(identity.event_id_column).alias("event_id"),
        identifier("aggregate_id").alias("aggregate_id"),
        identifier("event_name").alias("event_name"),
        F.lit(generation).alias("generation"),
        F.lit(False).alias("replay"),
        F.when(accepted, typed).alias("row"),
        F.when(accepted, _payload(identity)).alias("payload"),
        F.when(accepted, _string_members(identity)).alias("strings"),
        "reject_reason",
        *keep,
    )


def accepted_prefix(decoded: DataFrame, partitions: int) -> DataFrame:
    """The records that may go on: per log partition, those before the first reject.

    One aggregate with a row per stopped partition joined back (broadcast while ``partitions`` bounds
    it), not a window: a log partition is never sorted or gathered in one task. ``decoded`` is read twice: pass a
    stored table.
    """
    stops = (
        decoded.filter(F.col("reject_reason").isNotNull()).groupBy("topic", "partition").agg(F.min("offset").alias("stop"))
    )
    joined = decoded.join(small_side(stops, partitions), ["topic", "partition"], "left")
    return joined.filter(F.col("stop").isNull() | (F.col("offset") < F.col("stop"))).drop("stop", "reject_reason")


def blocked_sources(decoded: DataFrame) -> DataFrame:
    """Sources with a reject: the reason and position of the first one."""
    position = F.struct("partition", "offset")
    return (
        decoded.filter(F.col("reject_reason").isNotNull())
        .groupBy("source_id")
        .agg(
            F.min_by("reject_reason", position).alias("reason"),
            F.min(F.struct("partition", "offset", "topic")).alias("first"),
        )
        .select(
            "source_id",
            "reason",
            F.col("first.topic").alias("topic"),
            F.col("first.partition").alias("partition"),
            F.col("first.offset").alias("offset"),
        )
    )
