"""Case-insensitive lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup_ci(
    df: DataFrame, lookup: DataFrame, key: str, keep: str = "fact", replaced: Sequence[str] = ("channel",)
) -> DataFrame:
    """Inner join on ``lower(key)``.

    Rows without a lookup entry go, doubled lookup rows multiply. ``keep`` says
    whose spelling of the key survives: ``fact`` or ``lookup``. A fact column
    named in ``replaced`` is taken from the lookup; any other column that both have
    is an error, so a lookup never overwrites facts. No broadcast hint: the lookup is a stored table whose size Spark reads from its
    files, so it is broadcast while small and shuffled otherwise.
    """
    extra = [c for c in lookup.columns if c != key]
    clash = sorted({*df.columns} & {*extra} - {*replaced})
    if clash:
        raise ValueError(f"the lookup would overwrite {clash}")
    facts = df.drop(*extra)
    side = lookup.select(F.col(key).alias("__lookup_key"), *extra)
    joined = facts.join(side, F.lower(key) == F.lower("__lookup_key"), "inner")
    kept = F.col(key) if keep == "fact" else F.col("__lookup_key")
    others = [c for c in facts.columns if c != key]
    return joined.select(*others, *extra, kept.alias(key))


def unmapped(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Side report: keys the lookup does not know, with their row counts."""
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    known = lookup.select(F.lower(key).alias("__known"))
    return counts.join(known, F.lower(key) == F.col("__known"), "left_anti")
