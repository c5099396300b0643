"""Ordered rule lists as data, compiled to one CASE expression.

A rule is ``(value, condition)``; the first condition that is true wins and a
NULL condition does not match. Conditions are built from ``has``, ``like``,
``one_of``, ``every`` and ``no``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adloom.sources.staging import stage


@dataclass(frozen=True)
class Like:
    column: str
    pattern: str
    fold: bool  # compare in lower case


@dataclass(frozen=True)
class Group:
    parts: tuple
    every: bool


@dataclass(frozen=True)
class No:
    part: object


def has(columns: str | Sequence[str], *keywords: str) -> Like | Group:
    """Any of the columns contains any of the keywords, case ignored (``_`` matches one character)."""
    names = [columns] if isinstance(columns, str) else list(columns)
    found = tuple(Like(c, f"%{k}%", True) for k in keywords for c in names)
    return found[0] if len(found) == 1 else Group(found, every=False)


def like(column: str, pattern: str, fold: bool = False) -> Like:
    return Like(column, pattern, fold)


def one_of(*parts) -> Group:
    return Group(parts, every=False)


def every(*parts) -> Group:
    return Group(parts, every=True)


def no(part) -> No:
    return No(part)


def _columns(condition) -> set[str]:
    if isinstance(condition, Like):
        return {condition.column} if condition.fold else set()
    if isinstance(condition, No):
        return _columns(condition.part)
    return set().union(*(_columns(p) for p in condition.parts))


def _compile(condition) -> str:
    """SQL text of a condition over the lowered copies of its columns."""
    if isinstance(condition, Like):
        subject = _lowered(condition.column) if condition.fold else f"`{condition.column}`"
        return f"{subject} LIKE {_literal(condition.pattern)}"
    if isinstance(condition, No):
        return f"NOT ({_compile(condition.part)})"
    joint = " AND " if condition.every else " OR "
    return "(" + joint.join(_compile(p) for p in condition.parts) + ")"


def _lowered(column: str) -> str:
    return f"`__lower_{column}`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify(df: DataFrame, out: str, rules: Sequence[tuple[str, object]], default: Column | str) -> DataFrame:
    """Add ``out``. Each tested column is lowered once per row, not once per rule."""
    tested = sorted(set().union(*(_columns(c) for _, c in rules)))
    lowered = df.withColumns({_lowered(c).strip("`"): F.lower(c) for c in tested}) if tested else df
    arms = " ".join(f"WHEN {_compile(condition)} THEN {_literal(value)}" for value, condition in rules)
    otherwise = default if isinstance(default, Column) else F.lit(default)
    found = F.coalesce(F.expr(f"CASE {arms} END"), otherwise)
    return lowered.withColumn(out, found).drop(*[_lowered(c).strip("`") for c in tested])


def _tested(condition) -> set[str]:
    """Columns that a condition looks at."""
    if isinstance(condition, Like):
        return {condition.column}
    if isinstance(condition, No):
        return _tested(condition.part)
    return set().union(*(_tested(p) for p in condition.parts))


def classify_by_map(
    df: DataFrame,
    out: str,
    rules: Sequence[tuple[str, object]],
    default: Column | str,
    also: Sequence[str] = (),
    store: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """As ``classify``, but the rules are tried once for each distinct tuple of the columns they look at, not once for each row.

    The map of tuples is stored, so Spark knows its size: it is broadcast below
    the threshold and shuffled (hot tuples split) beyond it. Tuples with NULLs
    match their like. ``also`` names columns that only the default looks at.
    """
    columns = sorted(set().union(*(_tested(c) for _, c in rules), also))
    found = store(classify(df.select(*columns).distinct(), out, rules, default), "classes")
    renamed = found.select(*[F.col(c).alias(f"__{c}") for c in columns], out)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns]
    return df.join(renamed, same, "left").drop(*[f"__{c}" for c in columns])
