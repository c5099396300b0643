"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pick_one(
    df: DataFrame,
    keys: Sequence[str],
    largest: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
    number_as: str | None = None,
) -> DataFrame:
    """Keep one row per key: the largest by ``largest`` (NULL last), ties by ``tie_break``.

    ``tie_break`` defaults to every column that is not a key, ascending with
    NULLs last, which makes the choice independent of the input order. The
    ``= 1`` filter lets Spark cut each key down to one row per task before the
    shuffle, so a key that holds a large share of the rows stays harmless.
    """
    rest = [c for c in df.columns if c not in keys] if tie_break is None else tie_break
    ordering = [f"`{c}` DESC NULLS LAST" for c in largest] + [f"`{c}` ASC NULLS LAST" for c in rest]
    partition = ", ".join(f"`{k}`" for k in keys)
    rank = F.expr(f"row_number() OVER (PARTITION BY {partition} ORDER BY {', '.join(ordering) or '1'})")
    first = df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return first.withColumn(number_as, F.lit(1).cast("bigint")) if number_as else first
