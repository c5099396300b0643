"""Pick values out of arrays of ``{action_type, value}`` structs, row by row.

The arrays come typed out of ``parse_envelope``, so nothing is parsed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The picked text is read once more as a JSON scalar before the cast, so only
# JSON integer spellings count ("07" and "+7" do not).
_JSON_INTEGER = r"^\s*(-?(?:0|[1-9][0-9]*))\s*$"


def json_first_match(array: Column, key: str, value: str, out: str) -> Column:
    """``out`` of the first element whose ``key`` equals ``value``; NULL without one."""
    return F.get(F.filter(array, lambda e: e[key] == F.lit(value)), 0)[out]


def json_first(array: Column, out: str) -> Column:
    return F.get(array, 0)[out]


def json_last(array: Column, out: str) -> Column:
    return F.try_element_at(array, F.lit(-1))[out]


def json_integer(text: Column) -> Column:
    """BIGINT of a text that is a JSON integer, else NULL."""
    return F.regexp_extract(text, _JSON_INTEGER, 1).try_cast("bigint")
