"""One spelling per name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adloom.sources.refresh import Refresh
from adloom.sources.staging import stage


def spelling_map(df: DataFrame, col: str) -> DataFrame:
    """Smallest spelling of every name that occurs in more than one spelling.

    The distinct step runs first and map-side, so the grouping on the lowered
    name only sees one row per spelling however often a name occurs.
    """
    return (
        df.select(F.col(col).alias("__spelling"))
        .distinct()
        .groupBy(F.lower("__spelling").alias("__folded"))
        .agg(F.min("__spelling").alias("__canonical"), F.count("*").alias("__spellings"))
        .where((F.col("__spellings") > 1) & F.col("__folded").isNotNull())
        .select("__folded", "__canonical")
    )


def canonical_spelling(
    df: DataFrame,
    col: str,
    out: str,
    trim: bool = False,
    store: Callable[[DataFrame, str], DataFrame] = stage,
    names: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: ``col`` with every spelling replaced by the smallest one that differs only in case.

    The map of multiply spelled names is written out first. Spark then knows its
    real size and broadcasts it below the broadcast threshold, or shuffles (and
    splits hot names) above it. ``names`` may give the rows that hold the names
    where that is cheaper than computing ``df`` a second time.
    """
    spellings = store(spelling_map(df if names is None else names, col), "spellings")
    matched = df.join(spellings, F.lower(col) == F.col("__folded"), "left")
    chosen = F.coalesce("__canonical", F.col(col))
    return matched.withColumn(out, F.trim(chosen) if trim else chosen).drop("__folded", "__canonical")


_NAMES, _ROWS = "names", "rows"


@dataclass
class SpellingTable:
    """Rows with one spelling per name, kept below ``folder`` by day, load by load.

    The smallest spelling of a name can only become smaller, so a table of names,
    their smallest spelling and the days that hold them is all that is
    remembered. A load merges its names into it, replaces its own days, and
    rewrites days that hold a name which got a smaller spelling. Spellings of
    rows that a reload of their day left out stay known.
    """

    spark: SparkSession
    folder: str
    col: str
    out: str
    day: str

    def __post_init__(self):
        self._refresh = Refresh(self.spark, self.folder, {_NAMES: [], _ROWS: [self.day]})

    def _schemas(self, schema: StructType) -> dict[str, StructType]:
        names = StructType.fromDDL("folded string, canonical string, days array<string>")
        return {_NAMES: names, _ROWS: StructType([*schema.fields, StructField(self.out, StringType())])}

    def rows(self, schema: StructType) -> DataFrame:
        """All rows so far, with the column ``out``; ``schema`` is that of the loads."""
        return self._refresh.read(_ROWS, self._schemas(schema)[_ROWS])

    def load(self, new: DataFrame) -> list[str]:
        """Add the rows of one load, whose days replace stored ones; returns the days that were written."""
        schemas = self._schemas(new.schema)
        self._refresh.recover(schemas)
        new = stage(new, "new")
        day = F.coalesce(F.col(self.day).cast("string"), F.lit(""))
        fresh = new.where(F.col(self.col).isNotNull()).select(F.lower(self.col).alias("folded"), F.col(self.col).alias("canonical"), day.alias("day")).distinct()
        fresh = fresh.groupBy("folded").agg(F.min("canonical").alias("canonical"), F.collect_set("day").alias("days"))
        known = self._refresh.read(_NAMES, schemas[_NAMES])
        met = fresh.join(known.select("folded", F.col("canonical").alias("old"), F.col("days").alias("old_days")), "folded", "left")
        met = stage(
            met.select(
                "folded",
                F.least("canonical", "old").alias("canonical"),
                F.array_sort(F.array_union("days", F.coalesce("old_days", F.array().cast("array<string>")))).alias("days"),
                (F.col("canonical") < F.col("old")).alias("smaller"),
                "old_days",
            ),
            "met",
        )
        loaded = {r.day for r in new.select(day.alias("day")).distinct().collect()}
        again = {r.day for r in met.where("smaller").select(F.explode("old_days").alias("day")).distinct().collect()} - loaded
        names = known.join(met.select("folded"), "folded", "left_anti").unionByName(met.select("folded", "canonical", "days"))
        names = stage(names, "names")
        stored = self.rows(new.schema).where(day.isin(*sorted(again))).drop(self.out)
        rows = new.unionByName(stored) if again else new
        spellings = names.select(F.col("folded").alias("__folded"), F.col("canonical").alias("__canonical"))
        spelled = rows.join(spellings, F.lower(self.col) == F.col("__folded"), "left").withColumn(self.out, F.col("__canonical"))
        self._refresh.prepare({_NAMES: names, _ROWS: spelled.select(*schemas[_ROWS].names)})
        self._refresh.finish(schemas)
        return sorted(loaded | again)
