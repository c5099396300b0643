"""Intermediate tables and files of the operators, in the folder that all executors share.

A staged frame is written as Parquet and read back: its lineage is cut, lost
executors cost nothing, and Spark plans the next step by its real size.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None
#: Settings of a session's Arrow batches, and the most that the operators let them be.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; in local mode without it, a folder of this process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="adloom-llm-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver found it.

    On a cluster the package comes with --py-files or is installed; the path is harmless there.
    Batches of whole texts would hold tens of MB on both sides, so the session's are made
    smaller; as frames are lazy, that stays.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([*paths, root])
    for name, most in BATCH.items():
        now = re.match(r"(-?\d+)b?$", spark.conf.get(name))
        if now is None or not 0 < int(now[1]) <= most:
            spark.conf.set(name, str(most))


class Workspace:
    """One run's folder. Tables a run no longer needs can be dropped before it ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._staged: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        self._staged.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_only(self, *names: str) -> None:
        """Drop every table but those that the result still reads."""
        for name in [n for n in self._staged if n not in names]:
            self.drop(name)
            self._staged.remove(name)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores put before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
