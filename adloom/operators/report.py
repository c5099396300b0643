"""Dimension/metric reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F


def dimension_report(
    df: DataFrame,
    dims: Sequence[str],
    metrics: Sequence[str],
    date_col: str,
    start: dt.date | str,
    end: dt.date | str,
    filters: Sequence[Column] = (),
    keep_empty: bool = False,
) -> DataFrame:
    """Sum ``metrics`` by ``dims`` over a closed date range.

    ``keep_empty`` keeps groups whose metrics are all zero or NULL. Range and
    filters are plain column predicates, so they reach a Parquet scan.
    """
    day = F.col(date_col)
    first, after = F.lit(str(start)).cast("date"), F.date_add(F.lit(str(end)).cast("date"), 1)
    rows = df.where(reduce(and_, filters, (day >= first) & (day < after)))
    report = rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in metrics])
    if keep_empty or not metrics:
        return report
    empty = reduce(and_, (F.coalesce(F.col(m), F.lit(0)) == 0 for m in metrics))
    return report.where(~empty)
