"""Approximate nearest neighbours over shifted space-filling curves.

Vectors are scaled to length one and projected by several random rotations,
each with a shift of its own; the projected coordinates are ranked along a
Hilbert curve. Each ordering is range-partitioned and numbered in Spark, cut
into blocks of neighbouring keys, and every query is sent to the blocks that
its window reaches. There its neighbours are scored by their exact cosine, and
the best of all windows merge.

A window is a share of the ordering, and some rows at least, so recall stays
the same as the table grows. Vectors without structure (all directions alike) need wide windows; for
clustered ones a small ``share`` does. Equal vectors are indexed once, with
their smallest ids, so a vector held by a third of the rows costs one point.
Near copies that share a cell of the grid are ordered by a second curve inside
the cell, so however close they are, orderings differ.

Defined results: vectors that are null or zero, hold null or non-finite
components, or have another length than most take no part; nor do rows with a
null id. Rows that repeat both id and vector count once. A query has fewer than
``k`` rows if there are fewer candidates. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from adloom.llm.workspace import Workspace

DIMENSIONS = 4
BITS = 12
#: Rows of a window on each side of a query, at least; and queries that meet a block in one task.
LEAST_REACH, MOST_QUERIES = 64, 20_000
#: Bits of the curve inside a cell.
INNER_BITS = 15


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (n, d), 0 <= cell < 2^bits, d * bits <= 63."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):  # undo the reflections and swaps of every coarser level
        low = (1 << level) - 1
        for i in range(d):
            set_ = (x[i] >> level) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap if i else 0
    for i in range(1, d):  # Gray code across the coordinates
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(
    unit: np.ndarray, ordering: int, bits: int = BITS, dimensions: int = DIMENSIONS
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unit vectors in one ordering, a random rotation's first coordinates, shifted, on a grid; and keys inside the cells."""
    rng = np.random.default_rng(1000 + ordering)
    d = unit.shape[1]
    kept = min(dimensions, d)
    turned = unit @ np.linalg.qr(rng.normal(size=(d, d)))[0][:, :kept]
    # Projections of unit vectors spread as 1 / sqrt(d); four of that on each side, and a shift of up to half a side.
    scaled = np.clip(turned * np.sqrt(d) / 8 + 0.5, 0, 1) * 0.66 + rng.uniform(0, 0.33, kept)
    cells = np.minimum((scaled * (1 << bits)).astype(np.int64), (1 << bits) - 1)
    inside = ((scaled * (1 << bits) - cells) * (1 << INNER_BITS)).astype(np.int64)
    return hilbert_keys(cells, bits), hilbert_keys(np.clip(inside, 0, (1 << INNER_BITS) - 1), INNER_BITS)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Distinct rows (vec_id, v) that take part; ``vec_id`` and ``v`` are long and array of double."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else -1)).distinct()


def nearest(
    vectors: DataFrame,
    is_query: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    orderings: int = 14,
    share: float = 0.10,
    block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found by cosine, for every row that ``is_query`` admits (by id)."""
    spark = vectors.sparkSession
    space = Workspace(spark, "curves")
    rows = space.stage(usable(vectors, vec_id, vector), "rows")
    # One point per distinct vector, with its k + 1 smallest ids: one may be the query's own.
    order = Window.partitionBy("v").orderBy("vec_id")
    points = (
        rows.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    queries = rows.withColumnRenamed("vec_id", vec_id).where(is_query).withColumnRenamed(vec_id, "vec_id")
    asked = queries.select("v").distinct().withColumn("asked", F.lit(True))
    points = points.join(asked, "v", "left").select(
        F.element_at("ids", 1).alias("point"), "ids", "v", F.coalesce("asked", F.lit(False)).alias("asked")
    )
    points = space.stage(points, "points")

    def order_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _matrix(batch.column(2))
            unit = unit / np.sqrt((unit * unit).sum(1, keepdims=True))
            for o in range(orderings):
                key, inner = curve_keys(unit, o)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, o, np.int32)), pa.array(key), pa.array(inner), *batch.columns],
                    ["ordering", "key", "inner_key", *batch.schema.names],
                )

    keyed = points.mapInArrow(order_all, "ordering int, key long, inner_key long, point long, ids array<long>, v array<double>, asked boolean")
    along = ["ordering", "key", "inner_key", "point"]
    sorted_ = keyed.repartitionByRange(*along).sortWithinPartitions(*along)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seen, seen + n)), *batch.columns],
                ["part", "nth", *batch.schema.names],
            )
            seen += n

    fields = ", ".join(f"{n} {t}" for n, t in keyed.dtypes)
    numbered = space.stage(sorted_.mapInArrow(number, f"part int, nth long, {fields}"), "numbered")
    # Where each ordering begins in each partition: as many rows as partitions and orderings.
    counts = numbered.groupBy("ordering", "part").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    earlier = Window.partitionBy("ordering").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        "ordering", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    placed = numbered.join(begins, ["ordering", "part"]).withColumn("at", F.col("nth") + F.col("shift"))
    total = points.count()
    reach = max(LEAST_REACH, k + 1, int(np.ceil(share * total / 2)))
    # Queries that reach a block are dealt to parts, so that no task holds more of them than that, about.
    reaching = points.where("asked").count() * min(1.0, (2 * reach + block) / max(1, total))
    parts = max(1, int(np.ceil(reaching / MOST_QUERIES)))

    held = placed.select(
        "ordering",
        F.floor(F.col("at") / block).cast("long").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "at",
        "point",
        "ids",
        "v",
    )
    low, high = F.greatest(F.lit(0), F.col("at") - reach), F.least(F.lit(max(0, total - 1)), F.col("at") + reach)
    windows = placed.where("asked").select(
        F.col("ordering").alias("q_ordering"),
        F.explode(F.sequence(F.floor(low / block).cast("long"), F.floor(high / block).cast("long"))).alias("q_block"),
        F.pmod(F.xxhash64("point"), F.lit(parts)).cast("int").alias("q_part"),
        low.alias("low"),
        high.alias("high"),
        F.col("point").alias("query"),
        F.col("v").alias("q"),
    )

    def score(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "score": [], "ids": []})
        if not len(points) or not len(queries):
            return empty
        points = points.sort_values("at", kind="stable")
        p, at = np.stack(points.v.to_list()), points["at"].to_numpy()
        p_norm = np.sqrt((p * p).sum(1))
        ids, first = points.ids.to_list(), points.point.to_numpy()
        out = []
        for query, v, low, high in zip(queries["query"], queries.q, queries.low, queries.high, strict=True):
            a, b = np.searchsorted(at, low), np.searchsorted(at, high, "right")
            if a == b:
                continue
            q = np.asarray(v)
            q_norm = np.sqrt((q * q).sum())
            rough = p[a:b] @ q / p_norm[a:b]
            some = np.argpartition(-rough, k + 3)[: k + 4] if b - a > k + 4 else np.arange(b - a)
            # Summed the same way wherever a pair meets, so equal vectors get equal scores.
            exact = (p[a:b][some] * q).sum(1) / (p_norm[a:b][some] * q_norm)
            for i in np.lexsort((first[a:b][some], -exact))[: k + 1]:
                out.append((query, exact[i], ids[a + some[i]]))
        return pd.DataFrame(out, columns=["query", "score", "ids"]) if out else empty

    near = held.groupBy("ordering", "block", "part").cogroup(windows.groupBy("q_ordering", "q_block", "q_part")).applyInPandas(
        score, "query long, score double, ids array<long>"
    )
    found = near.groupBy("query", F.element_at("ids", 1).alias("point")).agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    # Ids of all those points, best first, ties to smaller ids; k + 1 of them hold k others for any query.
    pairs = top.select("query", "score", F.explode("ids").alias("vec_id"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= 2 * (k + 1))
    lists = ranked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    owners = queries.join(points.where("asked").select("v", F.col("point").alias("query")), "v").select(
        F.col("vec_id").alias("query_id"), "query"
    )
    answers = owners.join(lists, "query").select(
        "query_id",
        F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("i", "x"),
    )
    return answers.select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
