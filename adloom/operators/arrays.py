"""Attributes collected per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def distinct_array(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key with the sorted distinct non-null values of each column.

    All columns go through one scan and one grouping: a row becomes one value
    per column, and these are made distinct before they are collected. The first
    shuffle is on key and value, so a key with very many rows arrives as its few
    values only.
    """
    names = [spare_name(df, f"__{i}") for i in range(len(cols))]
    # A field per column keeps each type; all but one of them are NULL.
    fields = [
        F.struct(*[(F.col(c) if i == j else F.lit(None).cast(df.schema[c].dataType)).alias(n) for j, (c, n) in enumerate(zip(cols, names))])
        for i in range(len(cols))
    ]
    values = df.select(*keys, F.inline(F.array(*fields))).distinct()
    return values.groupBy(*keys).agg(*[F.sort_array(F.collect_list(n)).alias(c) for c, n in zip(cols, names)])


def order_text(*arrays: tuple[Column, Sequence[str]]) -> Column:
    """One text for arrays of structs of texts, each with the names of its fields, that sorts as the arrays do one after the other, NULL arrays last.

    A tie-break by arrays then moves a fraction of their bytes through a sort and
    a shuffle. Marks that sort below all characters end texts and arrays; a mark
    within a text is doubled.
    """

    def of_text(text: Column) -> Column:
        escaped = F.replace(text, F.lit("\0"), F.lit("\0\2"))
        return F.coalesce(F.concat(F.lit("\2"), escaped, F.lit("\0\1")), F.lit("\1"))

    def of_array(array: Column, names: Sequence[str]) -> Column:
        def of_any(e: Column) -> Column:
            return F.when(e.isNull(), "\1").otherwise(F.concat(F.lit("\2"), *[of_text(e[n]) for n in names]))

        def of_plain(e: Column) -> Column:
            # Nearly all elements are whole and hold no marks: one step makes the same text of these.
            whole = [F.lit("\2\2"), e[names[0]]] + [c for n in names[1:] for c in (F.lit("\0\1\2"), e[n])]
            return F.coalesce(F.concat(*whole, F.lit("\0\1")), of_any(e))

        marked = reduce(or_, [F.contains(F.array_join(array[n], ""), F.lit("\0")) for n in names])
        elements = F.when(marked, F.transform(array, of_any)).otherwise(F.transform(array, of_plain))
        return F.when(array.isNull(), "\2").otherwise(F.concat(F.lit("\1"), F.array_join(elements, ""), F.lit("\0")))

    return F.concat(*[of_array(array, names) for array, names in arrays])


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores put before it until no column of ``df`` has that name."""
    while wanted in df.columns:
        wanted = "_" + wanted
    return wanted
