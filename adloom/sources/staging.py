"""Intermediate tables in the cluster's shared folder.

A staged frame is written as Parquet and read back. That cuts the lineage in a
way that survives lost executors, keeps later reads columnar, and gives Spark
the true size of the frame, which is what decides broadcast or shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Lets a query remove its shuffle files when it ends, not when the driver happens to collect the frame.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_READ = "spark.sql.files.maxPartitionBytes"
#: Bytes of packed documents that a task reads where many columns of them go into a sort.
DOCUMENT_READ = 8 << 20

_chosen: str | None = None


def use_folder(folder: str | None) -> None:
    """The folder for sessions without ``spark.checkpoint.dir``; on a cluster one that all executors share."""
    global _chosen
    _chosen = folder


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else the folder given to ``use_folder``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _chosen
    if not folder:
        raise ValueError("set spark.checkpoint.dir, or call use_folder() with a folder that all executors share")
    return folder.rstrip("/")


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """The session with other settings for as long as the block runs."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def small_reads(spark: SparkSession) -> Iterator[None]:
    """Frames stored in this block read their files in small pieces.

    Documents unfold to many times their packed size, so a task that reads as
    much of them as of plain columns spills what it sorts.
    """
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    with configured(spark, **{_READ: str(min(now, DOCUMENT_READ))}):
        yield


class Staging:
    """A folder of staged tables that lives as long as its owner."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/adloom/{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """``compression`` is a codec of Parquet, the session's by default; documents take a third of the space with ``zstd``.

        Row groups of such documents are as small as the pieces that a task reads,
        as no group is split between tasks.
        """
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        # What was shuffled for a stored frame is not read again.
        with configured(self.spark, **{_CLEANUP: "true"}):
            groups = {"parquet.block.size": DOCUMENT_READ} if compression else {}
            df.write.mode("errorifexists").options(**groups).parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Stage one frame in a folder of its own, which stays like a checkpoint."""
    return Staging(df.sparkSession)(df, name, compression)
