"""Reload windows and high-water marks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


# The bound of an empty target, by type; text starts at the empty string.
_LOWEST = {
    "date": "0001-01-01",
    "timestamp": "0001-01-01 00:00:00",
    "timestamp_ntz": "0001-01-01 00:00:00",
    "int": str(-(2**31)),
    "bigint": str(-(2**63)),
    "double": "-Infinity",
}


def incremental_since(new: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows of ``new`` at or after the newest ``col`` in ``target``; all dated rows while it is empty.

    One comparison with one bound, so it reaches the scan. A row whose ``col`` is
    NULL belongs to no day and never comes.

    The newest day comes again in full, so replace that day's partition
    (``sinks.replace_partitions``) instead of appending.
    """
    kind = target.schema[col].dataType.simpleString()
    lowest = F.lit(_LOWEST.get(kind, "")).cast(kind)
    return new.where(F.col(col) >= target.select(F.coalesce(F.max(col), lowest)).scalar())


def lookback(
    df: DataFrame,
    col: str,
    days: int = 1,
    as_of: dt.date | str | None = None,
    time_zone: str = "Pacific/Auckland",
) -> DataFrame:
    """Rows from ``days`` before ``as_of`` on (default: today in ``time_zone``)."""
    if as_of is None:
        today = F.to_date(F.convert_timezone(None, F.lit(time_zone), F.localtimestamp()))
    else:
        today = F.lit(str(as_of)).cast("date")
    return df.where(F.col(col) >= F.date_sub(today, days))
