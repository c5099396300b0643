"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from adloom.sources.staging import configured

#: Partitions that a task writes side by side; only a task with more of them sorts its rows.
OPEN_FILES = 16


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows together by partition, or each task would write a small file into every partition.

    The rebalance splits partitions that are too large for one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a catalogue table."""
    _gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def save_path(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a Parquet folder."""
    _gathered(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``.

    The rows come gathered by partition, so a task has few of them and writes
    without sorting, which would hold its rows in memory.
    """
    with configured(df.sparkSession, **{"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        (
            _gathered(df, partition_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )


def save_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
