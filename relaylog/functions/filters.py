"""Destination filters. They fail open: only a string value outside the list is filtered."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaylog.functions import jsontext as J


def matches_filter(payload: Column, column: Column | str, values: Column) -> Column:
    """Filter test on payload JSON text. A null ``column`` or ``values`` means no filter."""
    name = F.concat(F.lit(column) if isinstance(column, str) else column, F.lit(J.MARK))
    members = J.members_of(payload)

    def last(named: Column) -> Column:
        # The last member of that name counts, as for any JSON object reader.
        return J.string_or_null(F.get(named, F.size(named) - 1))

    value = J.bind(F.map_values(F.map_filter(members, lambda k, _: k == name)), last)
    return F.coalesce(F.array_contains(values, value), F.lit(True))


def matches_strings(strings: Column, column: Column, values: Column) -> Column:
    """Filter test on the decoded string members (``strings`` of a decoded record): no parsing."""
    return F.coalesce(F.array_contains(values, F.try_element_at(strings, column)), F.lit(True))
