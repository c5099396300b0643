"""One row per key and sums over those rows, kept in tables and brought up to date load by load.

A load ranks its own rows only, compares the winners with the stored ones of
the same days, and rewrites days where a winner changed. Sums are corrected by
the replaced rows and their successors, not computed again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from adloom.operators.dedup import pick_one
from adloom.sources.refresh import Refresh
from adloom.sources.staging import Staging

_ROWS = "rows"


def changes(stored: DataFrame, new: DataFrame, keys: Sequence[str], largest: Sequence[str], picked: bool = False) -> DataFrame:
    """What ``new`` does to ``stored``, the winners so far: their columns, ``__won`` and ``__change``.

    ``__won`` marks the winner of every key. ``__change`` is 1 for a winner that
    is new, -1 for the stored row it replaces, and 0 for stored winners that
    stay. A row that is loaded again unchanged changes nothing. ``picked`` says
    that ``new`` has one row per key already.
    """
    fresh = new if picked else pick_one(new, keys, largest)
    both = stored.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
    rest = [c for c in stored.columns if c not in keys]
    order = [f"`{c}` DESC NULLS LAST" for c in largest] + [f"`{c}` ASC NULLS LAST" for c in rest] + ["__new"]
    window = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY {', '.join(order)})"
    ranked = both.selectExpr("*", f"row_number() {window} = 1 AS __won", f"first_value(__new) {window} = 1 AS __replaced")
    change = F.when(~F.col("__replaced"), 0).when(F.col("__won"), 1).otherwise(-1)
    # A new row that lost was never stored.
    return ranked.where("__won OR __new = 0").select(*stored.columns, "__won", change.alias("__change")).where("__won OR __change <> 0")


@dataclass(frozen=True)
class Sums:
    """Sums of ``measures`` (name: exact SQL type) by the day and ``by``, with the number of rows as ``n``.

    Measures are summed as integers or decimals, so that taking a row out
    leaves exactly what was there before it.
    """

    by: tuple[str, ...]
    measures: Mapping[str, str]

    def _exact(self, name: str, kind: str) -> Column:
        return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))

    def of_changes(self, changed: DataFrame, day: str) -> DataFrame:
        signed = [F.sum(self._exact(m, kind) * F.col("__change")).alias(m) for m, kind in self.measures.items()]
        return changed.where("__change <> 0").groupBy(day, *self.by).agg(F.sum("__change").alias("n"), *signed)

    def add(self, stored: DataFrame, delta: DataFrame, day: str) -> DataFrame:
        totals = [F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in ("n", *self.measures)]
        return stored.unionByName(delta.select(*stored.columns)).groupBy(day, *self.by).agg(*totals).where("n > 0").select(*stored.columns)


@dataclass
class LatestTable:
    """The current winner of every key below ``folder``, by day, and sums over the winners.

    ``day`` is one of ``keys``: a correction stays on its day, and a load reads
    and writes only days that it has rows of. Loading the same rows twice, or
    again after a run that died, changes nothing.
    """

    spark: SparkSession
    folder: str
    keys: Sequence[str]
    largest: Sequence[str]
    day: str
    sums: Mapping[str, Sums] = field(default_factory=dict)

    def __post_init__(self):
        if self.day not in self.keys:
            raise ValueError(f"{self.day} must be one of the keys")
        self._refresh = Refresh(self.spark, self.folder, {_ROWS: [self.day], **{name: [self.day] for name in self.sums}})

    def _schemas(self, schema: StructType) -> dict[str, StructType]:
        out = {_ROWS: schema}
        for name, sums in self.sums.items():
            wide = {m: f"decimal(38,{kind.split(',')[1].rstrip(')')})" if "," in kind else "bigint" for m, kind in sums.measures.items()}
            given = [f"`{c}` {schema[c].dataType.simpleString()}" for c in (self.day, *sums.by)]
            out[name] = StructType.fromDDL(", ".join([*given, "n bigint", *(f"`{m}` {kind}" for m, kind in wide.items())]))
        return out

    def rows(self, schema: StructType) -> DataFrame:
        """The winners, one row per key."""
        return self._refresh.read(_ROWS, schema)

    def summed(self, name: str, schema: StructType) -> DataFrame:
        """The sums of that name over the winners, whose columns ``schema`` has."""
        return self._refresh.read(name, self._schemas(schema)[name])

    def _of_days(self, days: list) -> Column:
        known = [d for d in days if d is not None]
        found = F.col(self.day).isin(*known) if known else F.lit(False)
        return found | F.col(self.day).isNull() if None in days else found

    def load(self, new: DataFrame) -> list:
        """Bring the tables up to date with ``new`` rows; returns the days that changed, one value each."""
        schemas = self._schemas(new.schema)
        self._refresh.recover(schemas)
        staging = Staging(self.spark)
        try:
            fresh = staging(pick_one(new, self.keys, self.largest), "fresh")
            days = [r[0] for r in fresh.select(self.day).distinct().collect()]  # the days of one load
            stored = self.rows(new.schema).where(self._of_days(days))
            ranked = staging(changes(stored, fresh, self.keys, self.largest, picked=True), "ranked")
            changed = [r[0] for r in ranked.where("__change <> 0").select(self.day).distinct().collect()]
            if changed:
                self._refresh.prepare(self._frames(ranked, changed, new.schema))
                self._refresh.finish(schemas)
            return sorted(changed, key=lambda d: (d is None, d))
        finally:
            staging.close()

    def _frames(self, ranked: DataFrame, changed: list, schema: StructType) -> dict[str, DataFrame]:
        touched = self._of_days(changed)
        frames = {_ROWS: ranked.where("__won").where(touched).select(*schema.names)}
        for name, sums in self.sums.items():
            stored = self.summed(name, schema).where(touched)
            frames[name] = sums.add(stored, sums.of_changes(ranked, self.day), self.day)
        return frames
