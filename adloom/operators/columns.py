"""Column selection and naming."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame


def star_except(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_glob(df: DataFrame, *patterns: str) -> DataFrame:
    """Columns that match any pattern, in the frame's own order."""
    return df.select(*[c for c in df.columns if any(fnmatchcase(c, p) for p in patterns)])


def select_streams(frames: Mapping[str, DataFrame], patterns: Sequence[str]) -> dict[str, DataFrame]:
    """Apply ``stream.column`` patterns to a set of named frames."""
    pairs = [p.split(".", 1) for p in patterns]
    chosen = {}
    for name, df in frames.items():
        columns = [c for stream, c in pairs if fnmatchcase(name, stream)]
        if columns:
            chosen[name] = select_glob(df, *columns)
    return chosen


def normal_name(name: str) -> str:
    """Lower snake case; invalid characters and a leading digit take an underscore."""
    snake = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    clean = re.sub(r"[^0-9a-zA-Z_]", "_", snake).lower()
    return f"_{clean}" if clean[:1].isdigit() else clean


def normalise_columns(df: DataFrame) -> DataFrame:
    names = [normal_name(c) for c in df.columns]
    doubled = sorted({n for n in names if names.count(n) > 1})
    if doubled:
        raise ValueError(f"columns collide after renaming: {doubled}")
    return df.toDF(*names)
