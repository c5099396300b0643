"""Underscore-coded names: positional tokens, vocabularies, patterns, capitals."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


def split_on(text: Column, sep: str = "_") -> Column:
    """``F.split`` with a literal separator."""
    return F.split(text, re.escape(sep))


def token_of(
    parts: Column,
    n: int,
    min_len: int | None = None,
    default: str | None = None,
    null_default: str | None = None,
) -> Column:
    """Element ``n`` of an already split name.

    Without ``min_len`` a short name gives NULL. With it, names of fewer tokens
    give ``default`` and a NULL name gives ``null_default``.
    """
    picked = F.get(parts, n)
    if min_len is None:
        return picked
    count = F.array_size(parts)
    return (
        F.when(count >= min_len, picked)
        .when(count < min_len, F.lit(default))
        .otherwise(F.lit(null_default))
    )


def token(
    text: Column,
    n: int,
    sep: str = "_",
    min_len: int | None = None,
    default: str | None = None,
    null_default: str | None = None,
) -> Column:
    return token_of(split_on(text, sep), n, min_len, default, null_default)


@dataclass(frozen=True)
class Token:
    """Where a decoded column sits inside a coded name."""

    source: str
    n: int
    min_len: int | None = None
    default: str | None = None
    null_default: str | None = None


def decode_names(df: DataFrame, spec: dict[str, Token], sep: str = "_") -> DataFrame:
    """Add one column per entry of ``spec``, splitting each coded name once."""
    parts = {c: f"__parts_{c}" for c in sorted({t.source for t in spec.values()})}
    split = df.withColumns({p: split_on(F.col(c), sep) for c, p in parts.items()})
    tokens = {
        out: token_of(F.col(parts[t.source]), t.n, t.min_len, t.default, t.null_default) for out, t in spec.items()
    }
    return split.withColumns(tokens).drop(*parts.values())


def token_in(columns: Iterable[Column], vocabulary: Iterable[str], default: str, sep: str = "_") -> Column:
    """First token, in column order then token order, that is in the vocabulary.

    Case is ignored for the match and kept in the result. One regular expression
    per column, so the projection stays inside generated code.
    """
    edge = re.escape(sep)
    words = "|".join(re.escape(w) for w in vocabulary)
    pattern = rf"(?:^|{edge})((?i:{words}))(?={edge}|\z)"
    found = [F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")) for c in columns]
    return F.coalesce(*found, F.lit(default))


def regex_first(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, NULL where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


# Characters after which a new word starts.
WORD_BREAKS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def initcap_punct(text: Column) -> Column:
    """Capitalise words that are split by blanks or punctuation (``F.initcap`` knows blanks only)."""
    pieces = F.regexp_extract_all(
        F.lower(text), F.lit(f"([^{WORD_BREAKS}]+|[{WORD_BREAKS}]+)"), F.lit(1)
    )
    capital = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.array_join(capital, "")


def map_tokens(names: Column, n: int, sep: str = "_") -> Column:
    """Token ``n`` of every name in an array; missing and empty tokens are left out."""
    picked = F.transform(names, lambda e: F.get(split_on(e, sep), n))
    return F.filter(picked, lambda t: t.isNotNull() & (t != ""))


def map_regex(names: Column, pattern: str) -> Column:
    """Group 1 of ``pattern`` in every name of an array; names without a match are left out."""
    return F.filter(F.transform(names, lambda e: regex_first(e, pattern)), lambda t: t.isNotNull())


def join_array(values: Column, sep: str = ", ") -> Column:
    return F.array_join(values, sep)
