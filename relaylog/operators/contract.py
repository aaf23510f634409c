"""Capture contract: table facts, rule violations, identities, drift, names and registrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaylog.model import (
    EVENT_ID_COLUMN,
    NAME_PREFIX,
    ConfigError,
    Identity,
    Source,
    column_type,
    is_integer,
    is_supported,
)
from relaylog.model import Column as SourceColumn


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: column_type(f) for f in df.schema.fields}


def _countable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def table_facts(df: DataFrame, source: Source) -> DataFrame:
    """One row per configured column and the serial column: type, nulls, rows and (serial) uniqueness.

    Parquet carries no NOT NULL and no unique index, so both are measured, in one aggregate whose
    only shuffle is the distinct count of the serial column.
    """
    types = _types(df)
    present = [c for c in source.columns if c in types]
    serial = source.serial_column
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(present)]
    if serial in types and _countable(df.schema[serial].dataType):
        aggregates.append(F.count_distinct(F.col(f"`{serial}`")).alias("serials"))
    else:
        aggregates.append(F.lit(None).cast("long").alias("serials"))
    facts = [
        F.struct(
            F.lit(i).alias("pos"),
            F.lit(c).alias("name"),
            F.lit(types.get(c)).cast("string").alias("type"),
            F.lit(c in types).alias("exists"),
            (F.col(f"nulls_{present.index(c)}") if c in present else F.lit(None)).cast("long").alias("nulls"),
            F.col("rows").alias("rows"),
            F.when(
                F.lit(c == serial), F.col("serials") == F.col("rows") - F.col(f"nulls_{present.index(c)}")
            ).alias("serial_unique")
            if c in present
            else F.lit(None).cast("boolean").alias("serial_unique"),
        )
        for i, c in enumerate(source.columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*facts)))


_VIOLATION = T.StructType(
    [
        T.StructField("rule_order", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("detail", T.StringType()),
    ]
)


def check_contract(df: DataFrame | None, source: Source) -> DataFrame:
    """Every broken rule, in rule order; the lowest is the one a single error would name. Empty is good.

    What the schema alone decides is decided on the driver; nulls and uniqueness come from
    ``table_facts``. None is a table that does not exist.
    """
    if df is None:
        return missing_table(SparkSession.active(), source)
    # The sentences of the rules, in the order of the checks.
    types = _types(df)
    facts = table_facts(df, source)
    serial, key = source.serial_column, source.partitioning_column
    fixed = [
        (1, "unsupported type", c, f'column "{c}" has unsupported type "{types[c]}"')
        for c in source.columns
        if c in types and not is_supported(types[c])
    ]
    missing = [c for c in source.columns if c not in types]
    if missing:
        fixed.append((2, "missing columns", ", ".join(missing), f"missing configured columns: {', '.join(missing)}"))
    if serial not in types:
        fixed.append((3, "serial missing", serial, f'serialColumn "{serial}" not found'))
    elif not is_integer(types[serial]):
        detail = f'serialColumn "{serial}" must be int2, int4, or int8, got "{types[serial]}"'
        fixed.append((4, "serial type", serial, detail))
    if key not in types:
        fixed.append((7, "partitioning missing", key, f'partitioningColumn "{key}" not found'))

    def violation(order: int, rule: str, column: str, detail: str) -> Column:
        return F.struct(
            F.lit(order).alias("rule_order"), F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.lit(detail).alias("detail")
        )

    def measured(is_broken: Column, *row) -> Column:
        return F.when(is_broken, violation(*row))

    name, nulls = F.col("name"), F.col("nulls")
    per_column = F.array(
        measured((name == serial) & (nulls > 0), 5, "serial null", serial, f'serialColumn "{serial}" must be NOT NULL'),
        measured(
            (name == serial) & ~F.col("serial_unique"),
            6,
            "serial not unique",
            serial,
            f'serialColumn "{serial}" has no unique or primary-key index on it alone',
        ),
        measured((name == key) & (nulls > 0), 8, "partitioning null", key, f'partitioningColumn "{key}" must be NOT NULL'),
        *[measured((name == source.columns[0]), *row) for row in fixed],
    )
    return facts.select(F.inline(F.filter(per_column, lambda v: v.isNotNull())))


def missing_table(spark, source: Source) -> DataFrame:
    """The contract result for a table that does not exist."""
    return spark.createDataFrame([(0, "missing table", source.table, "does not exist")], _VIOLATION)


def identity_from(df: DataFrame, source: Source, partitions: int) -> Identity:
    """The frozen identity of a table that has passed ``check_contract``."""
    types = _types(df)
    missing = [c for c in source.columns if c not in types]
    if missing:
        raise ConfigError(f"missing configured columns: {', '.join(missing)}")
    return Identity(
        table=source.table,
        serial_column=source.serial_column,
        partitioning_column=source.partitioning_column,
        event_id_column=EVENT_ID_COLUMN if EVENT_ID_COLUMN in source.columns else "",
        partitions=partitions,
        columns=tuple(SourceColumn(c, types[c]) for c in source.columns),
    )


def schema_drift(registered: DataFrame, current: DataFrame) -> DataFrame:
    """Positions at which the columns of a source differ from the registered ones.

    Both sides: ``source_id, pos, name, type``. Any difference, order included, blocks the source.
    """
    keys = ["source_id", "pos"]
    old = registered.select(*keys, F.struct("name", "type").alias("registered"))
    new = current.select(*keys, F.struct("name", "type").alias("current"))
    both = old.join(new, keys, "full_outer")
    return both.filter(~F.col("registered").eqNullSafe(F.col("current"))).select(
        *keys,
        F.col("registered.name").alias("registered_name"),
        F.col("registered.type").alias("registered_type"),
        F.col("current.name").alias("current_name"),
        F.col("current.type").alias("current_type"),
    )


#: What a source's identity and its resource names consist of, besides the columns. The order is the order of checks.
IDENTITY_FIELDS = ["table", "serial_column", "partitioning_column", "event_id_column", "partitions"]
NAME_FIELDS = ["topic_prefix", "topic", "connector", "slot", "publication"]


def identity_drift(registered: DataFrame, current: DataFrame) -> DataFrame:
    """Fields of identity and names that differ from the registered ones; any of them blocks the source.

    Both sides: ``source_id``, IDENTITY_FIELDS and NAME_FIELDS, one row per source. A registered source that is not
    there any more differs in every field; a source that is not registered yet does not drift.
    """
    fields = [("identity", f) for f in IDENTITY_FIELDS] + [("names", f) for f in NAME_FIELDS]
    texts = F.struct(*[F.col(f).cast("string").alias(f) for _, f in fields])
    old, new = registered.select("source_id", texts.alias("old")), current.select("source_id", texts.alias("new"))

    def row(kind: str, field: str) -> Column:
        values = {"kind": F.lit(kind), "field": F.lit(field), "registered": F.col(f"old.{field}"), "current": F.col(f"new.{field}")}
        return F.struct(*[v.alias(k) for k, v in values.items()])

    rows = F.array(*[row(k, f) for k, f in fields])
    both = old.join(new, "source_id", "left").select("source_id", F.inline(rows))
    return both.filter(~F.col("registered").eqNullSafe(F.col("current")))


def _hash_input(*members: Column) -> Column:
    """Compact JSON array of strings. The hash input spells these characters as escapes."""
    text = F.to_json(F.array(*[m.cast("string") for m in members]))
    for char in "<>&\u2028\u2029":
        text = F.replace(text, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return text


def stream_names(sources: DataFrame) -> DataFrame:
    """Add the resource names of each ``namespace, environment, source_id, generation, table``.

    The JSON array keeps ("a", "bc") and ("ab", "c") apart.
    """
    digest = F.sha2(_hash_input(F.col("namespace"), F.col("environment"), F.col("source_id"), F.col("generation")), 256)
    prefix = F.concat(
        F.lit(f"{NAME_PREFIX}_g"), F.col("generation").cast("string"), F.lit("_"), F.substring(digest, 1, 28)
    )
    return sources.withColumn("topic_prefix", prefix).select(
        *sources.columns,
        "topic_prefix",
        F.concat("topic_prefix", F.lit(".public."), "table").alias("topic"),
        F.concat("topic_prefix", F.lit("_connector")).alias("connector"),
        F.concat("topic_prefix", F.lit("_slot")).alias("slot"),
        F.concat("topic_prefix", F.lit("_pub")).alias("publication"),
    )


REGISTRATION_KEY = ["namespace", "environment", "generation", "source_id"]
_FROZEN = ["identity", "names", "topic_id"]


def insert_registration(existing: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, conflicts): a registered source is never overwritten, only compared.

    ``identity`` and ``names`` are canonical JSON text (sorted keys), so equal documents are equal text.
    """
    inserted = new.join(existing, REGISTRATION_KEY, "left_anti")
    old = existing.select(*REGISTRATION_KEY, F.struct(*_FROZEN).alias("registered"))
    both = new.join(old, REGISTRATION_KEY)
    conflicts = both.filter(~F.struct(*_FROZEN).eqNullSafe(F.col("registered"))).drop("registered")
    return inserted, conflicts
