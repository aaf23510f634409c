"""Value conversions: a marked JSON member of a known column type to its wire form.

Each ``to_*`` returns the wire text, or null when the value does not fit the type. JSON null is the
caller's business (``wire_value`` handles it), because null is valid for every type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaylog.functions import jsontext as J

MAX_EXPANDED_DIGITS = 1 << 20

# What a reject says about a column of each type.
INVALID = {
    "int2": "is not a valid int2",
    "int4": "is not a valid int4",
    "int8": "is not a valid int8",
    "float4": "is not a valid float4",
    "float8": "is not a valid float8",
    "bool": "is not a valid bool",
    "json": "is not valid JSON text",
    "bytea": "is not valid base64",
    "timestamp": "is not valid timestamp microseconds",
    "timestamptz": "is not valid RFC3339",
    "text": "is not a string",
}
NOT_A_STRING = "is not a string"

_SPARK_NAMES = {"int2": "smallint", "int4": "int", "int8": "bigint", "float4": "float", "float8": "double"}
STRING_TYPES = ("json", "bytea", "timestamp", "timestamptz", "text")


def _literal(value: Column) -> Column:
    return F.when(value.startswith(J.MARK) & ~J.is_string(value), J.literal(value))


# Digits of the largest number of each type, and its size.
_INT_DIGITS = {"int2": 5, "int4": 10, "int8": 19}
_INT_BITS = {"int2": 16, "int4": 32, "int8": 64}


def to_int(value: Column, type_name: str) -> Column:
    """By form and range: a cast that fails costs many times one that does not."""
    lit = _literal(value)
    digits, limit = _INT_DIGITS[type_name], 1 << (_INT_BITS[type_name] - 1)
    whole = lit.rlike(rf"^-?[0-9]{{1,{digits}}}$")
    if type_name == "int8":
        size = F.ltrim(lit, F.lit("-"))
        # Of 19 digits: as text, since not all of them are a bigint.
        most = F.when(lit.startswith("-"), str(limit)).otherwise(str(limit - 1))
        return F.when(whole & ((F.length(size) < digits) | (size <= most)), lit)
    number = F.when(whole, lit).cast("bigint")
    return F.when(number.between(-limit, limit - 1), lit)


def expand_decimal(lit: Column) -> Column:
    """A JSON number literal without its exponent, digit for digit; null beyond the size limit."""
    limit = F.lit(MAX_EXPANDED_DIGITS)
    as_written = ~lit.contains("e") & ~lit.contains("E") & (F.length(lit) <= limit)
    return F.when(as_written, lit).otherwise(J.bind(_scientific(lit), _placed))


def _scientific(lit: Column) -> Column:
    """struct(sign, digits, point): the number is 0.digits x 10^point; a null point is out of range."""
    whole = F.regexp_extract(lit, r"^-?([0-9]+)", 1)
    exponent_text = F.regexp_extract(lit, r"[eE]([+-]?[0-9]+)$", 1)
    exponent = F.when(exponent_text == "", F.lit(0)).otherwise(exponent_text.try_cast("int"))
    limits = (-MAX_EXPANDED_DIGITS, MAX_EXPANDED_DIGITS)
    point = F.when(exponent.between(*limits), F.length(whole) + exponent)
    return F.struct(
        F.when(lit.startswith("-"), "-").otherwise("").alias("sign"),
        F.concat(whole, F.regexp_extract(lit, r"\.([0-9]+)", 1)).alias("digits"),
        F.when(point.between(*limits), point).alias("point"),
    )


def _placed(number: Column) -> Column:
    digits, point = number["digits"], number["point"]

    def zeros(n: Column) -> Column:
        return F.repeat(F.lit("0"), n)

    placed = (
        F.when(point <= 0, F.concat(F.lit("0."), zeros(-point), digits))
        .when(point >= F.length(digits), F.concat(digits, zeros(point - F.length(digits))))
        .when(point > 0, F.concat(F.left(digits, point), F.lit("."), F.substr(digits, point + 1)))
    )
    return F.concat(number["sign"], F.regexp_replace(placed, r"^0+(?=[0-9])", ""))


def to_float(value: Column, type_name: str) -> Column:
    lit = _literal(value)
    number = lit.try_cast(_SPARK_NAMES[type_name])
    infinite = F.abs(number) == F.lit(float("inf"))
    return F.when(number.isNotNull() & ~infinite, expand_decimal(lit))


def to_bool(value: Column) -> Column:
    return F.when(value.isin("|true", "|false"), J.literal(value))


def to_text(value: Column) -> Column:
    return J.string_or_null(value)


def check_json_text(value: Column) -> Column:
    text = J.string_or_null(value)
    return F.when(J.is_json_value(text), text)


def to_base64(value: Column) -> Column:
    """Standard base64, padded or raw. Line breaks inside are allowed and kept."""
    text = J.string_or_null(value)
    body = F.translate(text, "\r\n", "")
    bare = F.rtrim(body, F.lit("="))
    padding = F.length(body) - F.length(bare)
    tail = F.length(bare) % 4
    shape = ((padding == 0) & (tail != 1)) | ((padding == 1) & (tail == 3)) | ((padding == 2) & (tail == 2))
    return F.when(bare.rlike(r"^[A-Za-z0-9+/]*+$") & shape, text)


def from_base64(text: Column) -> Column:
    body = F.rtrim(F.translate(text, "\r\n", ""), F.lit("="))
    return F.unbase64(F.concat(body, F.repeat(F.lit("="), F.pmod(-F.length(body), F.lit(4)))))


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def format_sql_timestamp(ntz: Column) -> Column:
    """SQL style text of a zone-free timestamp; a fraction only when there is one, zeros trimmed."""
    return F.ltrim(ntz.cast("string"), F.lit("+"))


def ntz_from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def micros_from_ntz(ntz: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), ntz)


def to_timestamp_text(value: Column) -> Column:
    return format_sql_timestamp(ntz_from_micros(_literal(value).try_cast("bigint")))


_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?(?:Z|[+-](?:[01][0-9]|2[0-3]):[0-5][0-9])$"


def to_timestamptz_text(value: Column) -> Column:
    """RFC 3339 text moved to UTC. The fraction is carried over as text: an offset cannot change it."""
    text = J.string_or_null(value)
    length = F.length(text)
    local = F.concat(F.left(text, F.lit(10)), F.lit(" "), F.substr(text, F.lit(12), F.lit(8))).try_cast("timestamp_ntz")
    offset = F.substr(text, length - 4, F.lit(2)).try_cast("int") * 60 + F.right(text, F.lit(2)).try_cast("int")
    behind = F.substr(text, length - 5, F.lit(1)) == "-"
    utc = F.when(text.endswith("Z"), local).otherwise(
        F.timestamp_add("MINUTE", F.when(behind, offset).otherwise(-offset), local)
    )
    zone_length = F.when(text.endswith("Z"), 1).otherwise(6)
    digits = F.rtrim(F.left(F.substr(text, F.lit(21), length - 20 - zone_length), F.lit(9)), F.lit("0"))
    fraction = F.when(digits == "", F.lit("")).otherwise(F.concat(F.lit("."), digits))
    return F.when(text.rlike(_RFC3339), F.concat(format_sql_timestamp(utc), fraction, F.lit("+00")))


def convert(type_name: str, value: Column) -> Column:
    """Wire text of a non-null marked value, null when it does not fit the type."""
    if type_name in ("int2", "int4", "int8"):
        return to_int(value, type_name)
    if type_name in ("float4", "float8"):
        return to_float(value, type_name)
    converters = {
        "bool": to_bool,
        "json": check_json_text,
        "bytea": to_base64,
        "timestamp": to_timestamp_text,
        "timestamptz": to_timestamptz_text,
        "text": to_text,
    }
    if type_name not in converters:
        raise ValueError(f"unsupported type {type_name!r}")
    return converters[type_name](value)


def wire_value(type_name: str, value: Column) -> Column:
    """Wire text, or SQL null for a JSON null, a missing or an invalid value."""
    return F.when(~J.is_null(value), convert(type_name, value))


def invalid_reason(type_name: str, value: Column, field: str) -> Column:
    """Why ``convert`` gave null. Names the field, never the value."""
    text = F.lit(f'field "{field}" {INVALID[type_name]}')
    if type_name in ("bytea", "timestamptz"):
        return F.when(~J.is_string(value), F.lit(f'field "{field}" {NOT_A_STRING}')).otherwise(text)
    return text


def typed_value(type_name: str, wire: Column) -> Column:
    """The wire text as a Spark value."""
    if type_name in _SPARK_NAMES:
        return wire.try_cast(_SPARK_NAMES[type_name])
    if type_name == "bool":
        return wire == "true"
    if type_name == "bytea":
        return from_base64(wire)
    if type_name == "timestamp":
        return wire.try_cast("timestamp_ntz")
    if type_name == "timestamptz":
        return F.timestamp_micros(micros_from_ntz(F.replace(wire, F.lit("+00"), F.lit("")).try_cast("timestamp_ntz")))
    return wire
