"""Strict JSON reading with built-in functions, keeping number literals digit for digit.

``from_json`` alone is too lenient (it ignores text after the value) and rewrites numbers
(``1.50e3`` becomes ``1500.0``). So every scalar token is first turned into a *marked string*:

* a string ``"abc"`` becomes ``"abc|"``: the mark at the end;
* a number, ``true``, ``false`` or ``null`` becomes ``"|1.50e3"``: the mark at the start.

Member names are strings too, so ``op`` is found under ``op|``. After that ``from_json`` returns
exact text, a marked value still tells its JSON kind, and a JSON null (``|null``) differs from a
missing member (SQL null). Text that is not JSON stays not JSON: a bad number like ``01`` turns
into two adjacent strings. Nothing in marked text is an unmarked scalar or name, so an unmarked
sentinel added behind the value proves that the value was the only one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "|"
NULL = "|null"

_BETWEEN = r'([^"\-0-9tfn]*+)'
_STRING = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_SCALAR = r"(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+\-]?+[0-9]++)?+|true|false|null)(?!\s*+:)"
# One match per scalar, each starting where the last one ended, so the scan is linear. It stops at
# a token that is none; the text behind it stays unmarked, and is not JSON because of that token.
_TOKEN = rf"\G{_BETWEEN}(?:{_STRING}|{_SCALAR})"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_SENTINEL = T.StructField("z", T.IntegerType())
_MEMBER_MAP = T.MapType(T.StringType(), T.StringType())


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def mark_scalars(text: Column) -> Column:
    return F.regexp_replace(F.rtrim(text), _TOKEN, '$1"$2|$3"')


def unmark(text: Column) -> Column:
    """Marked JSON text back to plain JSON text (white space is lost, digits are not)."""
    plain = F.regexp_replace(text, r'"\|(-?[0-9][0-9.eE+\-]*+|true|false|null)"', "$1")
    return F.replace(plain, F.lit('|"'), F.lit('"'))


def members_type(names: list[str]) -> T.StructType:
    """Struct type that picks these members out of marked text, each as its marked value."""
    return T.StructType([T.StructField(n + MARK, T.StringType()) for n in names])


def member(parsed: Column, name: str) -> Column:
    return parsed.getField(name + MARK)


def parse_single_object(marked: Column, names: list[str]) -> Column:
    """Array whose first element holds the members; see ``single_object`` for its use."""
    element = T.StructType([*members_type(names).fields, _SENTINEL])
    return F.from_json(F.concat(F.lit("["), marked, F.lit(',{"z":0}]')), T.ArrayType(element), _STRICT)


def single_object(parsed: Column) -> Column:
    """The parsed members when the text was exactly one object, else null."""
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1)).getField("z") == 0)
    return F.when(whole, F.get(parsed, F.lit(0)))


def parse_members(marked_object: Column, names: list[str]) -> Column:
    """Members of a value already known to be one marked object."""
    return F.from_json(marked_object, members_type(names), _STRICT)


def member_map(marked_object: Column) -> Column:
    """``object_members`` of a value already known to be one marked object."""
    return F.from_json(marked_object, _MEMBER_MAP, _STRICT)


def parse_value(text: Column) -> Column:
    """Array whose first element is the marked text of the value; see ``single_value`` for its use."""
    return F.from_json(
        F.concat(F.lit("["), mark_scalars(text), F.lit(",0]")), T.ArrayType(T.StringType()), _STRICT
    )


def single_value(parsed: Column) -> Column:
    """The marked text when there was exactly one JSON value, else null."""
    return F.when((F.size(parsed) == 2) & (F.get(parsed, F.lit(1)) == "0"), F.get(parsed, F.lit(0)))


def _single_value(text: Column) -> Column:
    return bind(parse_value(text), single_value)


def is_json_value(text: Column) -> Column:
    """True iff the text is exactly one JSON value of any kind."""
    return _single_value(text).isNotNull()


def is_single_object(text: Column) -> Column:
    """True iff the text is exactly one JSON object: not empty, nothing behind it."""
    return F.coalesce(_single_value(text).startswith("{"), F.lit(False))


def as_object(value: Column) -> Column:
    """The marked value if it is an object, else null."""
    return F.when(is_object(value), value)


def parse_object_members(text: Column) -> Column:
    """Array whose first element is the map of all members; see ``object_members`` for its use."""
    return F.from_json(
        F.concat(F.lit("["), mark_scalars(text), F.lit(',{"z":"0"}]')), T.ArrayType(_MEMBER_MAP), _STRICT
    )


def object_members(parsed: Column) -> Column:
    """All members, in order and with duplicates, names still marked, when there was exactly one object."""
    whole = (F.size(parsed) == 2) & F.map_contains_key(F.get(parsed, F.lit(1)), F.lit("z"))
    return F.when(whole, F.get(parsed, F.lit(0)))


def members_of(text: Column) -> Column:
    """``object_members`` of a text, or null unless it is exactly one object."""
    return bind(parse_object_members(text), object_members)


def raw_members(text: Column) -> Column:
    """Map of member name to struct(kind, text); null unless the text is exactly one object.

    ``text`` keeps the digits of a number as written, is the decoded string of a string, and the
    JSON text of an object or array. The last of several members of one name wins.
    """
    return bind(members_of(text), _described)


def _described(parsed: Column) -> Column:
    names = F.map_keys(parsed)
    last_of_name = F.filter(
        F.map_entries(parsed),
        lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]),
    )
    entries = F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_entries(parsed)).otherwise(last_of_name)
    return F.map_from_entries(
        F.transform(
            entries,
            lambda e: F.struct(
                string_value(e["key"]).alias("key"), F.struct(kind(e["value"]).alias("kind"), _plain(e["value"]).alias("text"))
            ),
        )
    )


def _plain(value: Column) -> Column:
    return (
        F.when(is_string(value), string_value(value)).when(value.startswith(MARK), literal(value)).otherwise(unmark(value))
    )


def kind(value: Column) -> Column:
    """JSON kind of a marked value."""
    return (
        F.when(is_string(value), "string")
        .when(value == NULL, "null")
        .when(value.isin("|true", "|false"), "boolean")
        .when(value.startswith(MARK), "number")
        .when(value.startswith("{"), "object")
        .when(value.startswith("["), "array")
    )


def is_null(value: Column) -> Column:
    return value == NULL


def is_string(value: Column) -> Column:
    return value.endswith(MARK)


def is_object(value: Column) -> Column:
    return value.startswith("{") & value.endswith("}")


def string_value(value: Column) -> Column:
    """The decoded content of a marked string."""
    return F.left(value, F.length(value) - 1)


def string_or_null(value: Column) -> Column:
    return F.when(is_string(value), string_value(value))


def literal(value: Column) -> Column:
    """The literal of a marked number, boolean or null."""
    return F.substr(value, F.lit(2))
