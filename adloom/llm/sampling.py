"""Bounded samples.

The smallest hashes win, so a sample is the same in every run. Rows that surely
don't make it are left out first, by a bound on the hash from the number of
rows; else every task would send the driver a sample of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def smallest(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The ``rows`` rows of the smallest ``key``, a 64-bit hash; ties in any order."""
    total = df.count()
    if total > 4 * rows:
        df = df.where(F.shiftrightunsigned(key, 1) < F.lit(int(2**63 * (2 * rows + 100) / total)))
    return df.orderBy(F.shiftrightunsigned(key, 1)).limit(rows)


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` documents, chosen by the hash of their id.

    The ids are chosen from the labels alone and sent to every task (16 bytes
    each), so no text is shuffled but the sample's. Of rows with equal ids the one
    whose text has the smallest hash counts; of contradicting labels the greater.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn_from)
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = smallest(known, F.xxhash64(F.col("doc_id"), F.lit("sample")), rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("y").alias("y"))
