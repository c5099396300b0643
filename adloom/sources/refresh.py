"""Replace partitions of several tables together, so that a run that dies halfway is finished by the next one.

The new partitions are first written in full beside the tables and marked as
complete; only then are the tables' partitions replaced, which may be done any
number of times. A run that finds marked partitions finishes them before it
reads a table; unmarked ones were never seen by anybody and go.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adloom.sources.sinks import replace_partitions, save_path

_PENDING, _MARK = "_pending", "_COMPLETE"


@dataclass(frozen=True)
class Refresh:
    """Tables ``<folder>/<name>``, each with the columns it is partitioned by."""

    spark: SparkSession
    folder: str
    partition_by: Mapping[str, Sequence[str]]

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder.rstrip("/"), *parts]))
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def exists(self, *parts: str) -> bool:
        store, path = self._path(*parts)
        return store.exists(path)

    def read(self, name: str, schema: StructType) -> DataFrame:
        """The table with the columns of ``schema``; empty before its first refresh."""
        if not self.exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").select(*schema.names)

    def prepare(self, frames: Mapping[str, DataFrame]) -> None:
        """Write the rows of the partitions that will replace those of the same values."""
        for name, df in frames.items():
            save_path(df, f"{self.folder}/{_PENDING}/{name}")
        store, path = self._path(_PENDING, _MARK)
        store.create(path, True).close()

    def finish(self, schemas: Mapping[str, StructType]) -> None:
        """Replace the partitions that were prepared."""
        for name, schema in schemas.items():
            if self.exists(_PENDING, name):
                rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{_PENDING}/{name}")
                replace_partitions(rows, f"{self.folder}/{name}", self.partition_by[name])
        self._drop_pending()

    def recover(self, schemas: Mapping[str, StructType]) -> None:
        """Finish what a run that died had prepared; drop what it had not."""
        if self.exists(_PENDING, _MARK):
            self.finish(schemas)
        elif self.exists(_PENDING):
            self._drop_pending()

    def _drop_pending(self) -> None:
        # The mark goes first: what is left without it counts for nothing.
        for parts in ((_PENDING, _MARK), (_PENDING,)):
            store, path = self._path(*parts)
            store.delete(path, True)
