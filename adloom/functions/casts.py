"""Text to typed values.

Every function takes ``strict``: False gives NULL for text that does not parse,
True lets the ANSI cast stop the query.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_long(text: Column, strict: bool = False) -> Column:
    return text.cast("bigint") if strict else text.try_cast("bigint")


def to_double(text: Column, strict: bool = False) -> Column:
    # Java reads "12d" and "12f" as numbers; an export never means that. What ends
    # in a digit has no such suffix, and most numbers do.
    digit_last = F.contains(F.lit("0123456789"), F.substring(text, -1, 1))
    java_suffix = ~digit_last & text.rlike(r"[0-9.][dDfF]\s*$")
    if strict:
        wrong = F.raise_error(F.concat(F.lit("not a number: "), text))
        return F.when(java_suffix, wrong).otherwise(text.cast("double"))
    return F.when(~java_suffix, text.try_cast("double"))


def decimal_comma(text: Column, strict: bool = False) -> Column:
    """``"1,5"`` -> 1.5"""
    return to_double(F.replace(text, F.lit(","), F.lit(".")), strict)


def percent(text: Column, strict: bool = False) -> Column:
    """``"12%"`` -> 12.0"""
    return to_double(F.replace(text, F.lit("%"), F.lit("")), strict)


# The date spellings found in the exports. One-letter patterns
# accept one or two digits.
DATE_PATTERNS = {
    "year_first_slash": "yyyy/M/d",
    "day_first_slash": "d/M/yyyy",
    "iso": "yyyy-M-d",
    "compact": "yyyyMMdd",
}


def to_date(text: Column, spelling: str, strict: bool = False) -> Column:
    pattern = DATE_PATTERNS[spelling]
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def iso_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def day_of(text: Column, strict: bool = False) -> Column:
    """Date part of a ``yyyy-MM-dd[ HH:mm:ss]`` text, date or timestamp."""
    return text.cast("date") if strict else text.try_cast("date")


def datetime_day(text: Column, strict: bool = False) -> Column:
    """Date of a full ``yyyy-MM-dd HH:mm:ss`` text; a bare date does not parse."""
    pattern = F.lit("yyyy-MM-dd HH:mm:ss")
    moment = F.to_timestamp_ntz(text, pattern) if strict else F.try_to_timestamp(text, pattern)
    return moment.cast("date")


def from_micros(micros: Column) -> Column:
    """Currency micros to currency units."""
    return micros / F.lit(1000000)
