"""Registry and helpers.

The test tables hold no ad data, so a query derives its raw rows from whole
tables with plain SQL that both Spark and the checking engine run; everything
after that is library code on one side and SQL over the plain columns on the
other.
"""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adloom.operators.envelope import LOAD_COLUMNS
from adloom.session import wide_session
from adloom.sources import staging
from adloom.sources.staging import Staging, stage


@functools.cache
def _local_folder() -> str:
    """For runs on one machine that name no shared folder; gone with the process."""
    folder = tempfile.mkdtemp(prefix="adloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def __post_init__(self):
        if not self.spark.conf.get("spark.checkpoint.dir", None) and self.spark.conf.get("spark.master", "").startswith("local"):
            staging.use_folder(_local_folder())

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def wide(self, **settings: str) -> Tables:
        """The same tables, for models of many columns, from documents that are packed closely."""
        return Tables(wide_session(self.spark, staging.DOCUMENT_READ, **settings), self.folder)

    def sql(self, text: str) -> DataFrame:
        """Run shared SQL; ``{lineitem}`` and the like stand for tables."""
        names = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


#: Least files of a derived raw table; small test tables are read by one task, raw tables are not.
ENVELOPE_FILES = 16

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query and the SQL it must agree with."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = plain_sql(oracle)
        return build

    return register


def plain_sql(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def choose(expr: str, values: Sequence[str | None]) -> str:
    """SQL text: the value at position ``expr`` modulo their number."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values)
    )
    return f"CASE {expr} % {len(values)} {arms} END"


def comparable(df: DataFrame, digits: int = 2) -> DataFrame:
    """Plain types for comparing: dates and times as text, arrays joined, doubles rounded."""

    def plain(name: str, kind: str) -> Column:
        col = F.col(name)
        if kind == "date":
            col = F.date_format(col, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("array"):
            col = F.array_join(col, "|")
        elif kind == "double":
            col = F.round(col, digits)
        return col.alias(name)

    return df.select(*[plain(n, k) for n, k in df.dtypes])


#: For timing: derived raw tables are made once and used again.
keep_raw = False
_raw: dict[int, DataFrame] = {}
_space: Staging | None = None


@contextmanager
def raw_in(space: Staging) -> Iterator[None]:
    """Raw tables derived in this block are staged in ``space``, whose owner removes them, if they are not kept for timing."""
    global _space
    _space = None if keep_raw else space
    try:
        yield
    finally:
        _space = None


def as_envelope(plain: DataFrame, members: dict[str, str | Column], loaded_at: str | None = None, compression: str | None = None) -> DataFrame:
    """A raw envelope table from plain columns; NULL members are left out of the JSON.

    The rows are staged, as raw data is stored before any model reads it.
    ``compression`` is for wide documents: of narrow ones a task would read too
    many rows in a closely packed file.
    """
    body = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(key) for key, c in members.items()])
    loaded = F.col(loaded_at) if loaded_at else F.lit("2024-01-01").cast("timestamp")
    load = {
        "_sdc_extracted_at": loaded.cast("timestamp"),
        "_sdc_received_at": loaded.cast("timestamp"),
        "_sdc_batched_at": loaded.cast("timestamp"),
        "_sdc_deleted_at": F.lit(None).cast("timestamp"),
        "_sdc_sequence": F.unix_millis(loaded.cast("timestamp")),
        "_sdc_table_version": F.lit(None).cast("bigint"),
    }
    assert list(load) == list(LOAD_COLUMNS)
    raw = _spread(plain).select(F.to_json(body).alias("data"), *[c.alias(n) for n, c in load.items()])
    if not keep_raw:
        return (_space or stage)(raw, "raw", compression)
    key = raw.semanticHash()
    if key not in _raw:
        _raw[key] = stage(raw, "raw", compression)
    return _raw[key]


def _spread(plain: DataFrame) -> DataFrame:
    """The rows, dealt anew only where few tasks hold them; tables that many tasks read need no shuffle."""
    tasks = plain.select(F.spark_partition_id().alias("task")).distinct().count()
    enough = min(ENVELOPE_FILES, plain.sparkSession.sparkContext.defaultParallelism)
    return plain if 2 * tasks >= enough else plain.repartition(ENVELOPE_FILES)


def nulls_last(*columns: str) -> str:
    """SQL text of an ascending tie-break."""
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)
