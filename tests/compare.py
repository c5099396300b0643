"""Row comparison between Spark and DuckDB, independent of row and column order."""

from __future__ import annotations

import datetime as dt
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    want_columns, want = rows_of(expected_columns, result.fetchall())
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns: only spark {set(got_columns) - set(want_columns)}, only sql {set(want_columns) - set(got_columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lost = [r for r in want if r not in set(got)][:2]
        detail = ""
        if extra and lost:
            detail = str([(c, a, b) for c, a, b in zip(got_columns, extra[0], lost[0]) if a != b])
        return f"rows {len(got)} vs {len(want)}; columns {got_columns}\n spark {extra}\n sql   {lost}\n {detail}"
    return None
