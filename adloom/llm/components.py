"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is two aggregations and two joins in Spark; nothing reaches the
driver but two counts. Each step's edges are staged, so a lost executor never
costs more than the step it was on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adloom.llm.workspace import Workspace


def components(edges: DataFrame, space: Workspace, name: str, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); the root is the component's smallest node, which has no row itself."""
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = space.stage(edges.where("a <> b").select(a, b).distinct(), f"{name}-0")
    seen = _state(now)
    for step in range(1, most + 1):
        # Large star: every greater neighbour of a node goes to the smallest node around it.
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every smaller neighbour of a node, and the node, go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(low, "a")
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        now = space.stage(small.distinct(), f"{name}-{step}")
        space.drop(f"{name}-{step - 1}")
        state = _state(now)
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {most} steps")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(row)
