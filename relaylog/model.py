"""Sources, identities, destinations and scopes: the small driver-side facts every job is built from."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

EVENT_ID_COLUMN = "event_id"

# The column types a source table may have.
INTEGER_TYPES = ("int2", "int4", "int8")
FLOAT_TYPES = ("float4", "float8")
SUPPORTED_TYPES = INTEGER_TYPES + FLOAT_TYPES + ("bool", "json", "bytea", "timestamp", "timestamptz", "text")

_BY_SPARK_TYPE = {
    T.ShortType: "int2",
    T.IntegerType: "int4",
    T.LongType: "int8",
    T.FloatType: "float4",
    T.DoubleType: "float8",
    T.BooleanType: "bool",
    T.StringType: "text",
    T.BinaryType: "bytea",
    T.TimestampNTZType: "timestamp",
    T.TimestampType: "timestamptz",
}

SPARK_TYPES = {
    "int2": T.ShortType(),
    "int4": T.IntegerType(),
    "int8": T.LongType(),
    "float4": T.FloatType(),
    "float8": T.DoubleType(),
    "bool": T.BooleanType(),
    "json": T.StringType(),
    "bytea": T.BinaryType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "text": T.StringType(),
}


def is_supported(type_name: str) -> bool:
    return type_name in SUPPORTED_TYPES


def is_integer(type_name: str) -> bool:
    return type_name in INTEGER_TYPES


def column_type(f: T.StructField) -> str:
    """The source type of a DataFrame column; text columns holding JSON carry ``{"type": "json"}`` metadata.

    A Spark type without an entry keeps its own name, which no contract accepts.
    """
    declared = (f.metadata or {}).get("type")
    if declared:
        return declared
    return _BY_SPARK_TYPE.get(type(f.dataType), f.dataType.simpleString())


class ConfigError(ValueError):
    """A source, destination, identity or scope that breaks a configuration rule."""


@dataclass(frozen=True)
class Source:
    id: str
    description: str
    table: str
    columns: tuple[str, ...]
    serial_column: str
    partitioning_column: str

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        if not self.id or not self.description:
            raise ConfigError("source id and description are required")
        if not self.table:
            raise ConfigError(f"source {self.id!r}: table is required")
        for name in (self.serial_column, self.partitioning_column):
            if not name or name not in self.columns:
                raise ConfigError(f"source {self.id!r}: columns must include the serial and partitioning columns")


@dataclass(frozen=True)
class Filter:
    column: str
    values: tuple[str, ...]

    def __post_init__(self):
        object.__setattr__(self, "values", tuple(self.values))
        if not self.column or not self.values:
            raise ConfigError("filter column and values are required")


@dataclass(frozen=True)
class Destination:
    id: str
    description: str
    sources: tuple[str, ...]
    filter: Filter | None = None

    def __post_init__(self):
        object.__setattr__(self, "sources", tuple(self.sources))
        if not self.id or not self.description:
            raise ConfigError("destination id and description are required")
        if not self.sources:
            raise ConfigError(f"destination {self.id!r}: sources are required")


def check_application(sources: list[Source], destinations: list[Destination]) -> None:
    """Duplicate ids, no source at all, and references to unknown sources."""
    known: set[str] = set()
    for s in sources:
        if s.id in known:
            raise ConfigError(f"duplicate source id {s.id!r}")
        known.add(s.id)
    if not known:
        raise ConfigError("at least one source is required")
    seen: set[str] = set()
    for d in destinations:
        if d.id in seen:
            raise ConfigError(f"duplicate destination id {d.id!r}")
        seen.add(d.id)
        for s in d.sources:
            if s not in known:
                raise ConfigError(f"destination {d.id!r}: unknown source {s!r}")


@dataclass(frozen=True)
class Scope:
    namespace: str
    environment: str
    generation: int = 1

    def __post_init__(self):
        if not self.namespace or not self.environment or self.generation < 1:
            raise ConfigError("namespace, environment and a positive generation are required")


@dataclass(frozen=True)
class Column:
    name: str
    type: str


@dataclass(frozen=True)
class Identity:
    """What a stream generation freezes about its table."""

    table: str
    serial_column: str
    partitioning_column: str
    event_id_column: str
    partitions: int
    columns: tuple[Column, ...] = field(default_factory=tuple)

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Identity:
        data = json.loads(text)
        data["columns"] = tuple(Column(**c) for c in data["columns"])
        return cls(**data)

    def check(self, source: Source, generation: int) -> None:
        """Refuse to decode with an identity that is inconsistent or belongs to another source."""
        # The sentences, in the order of the checks.
        if generation < 1:
            raise ConfigError("generation is invalid")
        if not self.table or self.table != source.table:
            raise ConfigError("identity table does not match source table")
        named = (self.serial_column, self.partitioning_column)
        names = tuple(c.name for c in self.columns)
        if named != (source.serial_column, source.partitioning_column) or not names or len(names) != len(source.columns):
            raise ConfigError("identity columns do not match source configuration")
        if self.partitions < 1:
            raise ConfigError("identity has invalid partition count")
        if names != source.columns or "" in names or len(set(names)) != len(names):
            raise ConfigError("identity has invalid configured columns")
        for c in self.columns:
            if not is_supported(c.type):
                raise ConfigError(f"configured column {c.name!r} has unsupported type")
        if not is_integer(self.column(self.serial_column).type):
            raise ConfigError(f"serial column {self.serial_column!r} has invalid type")
        if self.event_id_column and self.event_id_column not in names:
            raise ConfigError("identity is missing a required configured column")


NAME_PREFIX = "relay"


def name_prefix(scope: Scope, source_id: str) -> str:
    """Driver-side twin of ``operators.contract.stream_names`` for one source."""
    members = [scope.namespace, scope.environment, source_id, str(scope.generation)]
    text = json.dumps(members, separators=(",", ":"), ensure_ascii=False)
    # Characters the hash input spells as escapes.
    for char in "<>&\u2028\u2029":
        text = text.replace(char, f"\\u{ord(char):04x}")
    return f"{NAME_PREFIX}_g{scope.generation}_{hashlib.sha256(text.encode()).hexdigest()[:28]}"


def topic_name(scope: Scope, source: Source) -> str:
    return f"{name_prefix(scope, source.id)}.public.{source.table}"


RAW_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
