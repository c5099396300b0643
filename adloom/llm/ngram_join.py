"""N-gram Jaccard join: an R-tree over count vectors of hashed tokens, then exact verification.

Tokens (hashes of word shingles) fall into groups by their hash; how many a
document has in each group is its point. Two documents share at most the sum of
their smaller coordinates, so an R-tree node whose greatest coordinates don't
reach the overlap that the threshold asks for is skipped with all below it.
Pairs that survive are verified on their full sets.

Spark routes documents that can link to the same tree. By size class, hashes
are cut into ranges; documents of Jaccard t differ in at most r = (1 - t) / t *
size hashes, so of the first r + 1 ranges that hold any hash at least one is
equal in both. Points that share an equal range meet in a tree and are
candidates of each other if their coordinates allow a link; connected
candidates make a cluster. No other document can link to one of the cluster, so
a second tree over the cluster, now with the sets at hand, finds its links.
Equal sets are one node from the start.

A cluster above ``block`` documents is never one task: it is cut into blocks
along the tree's order. First every block meets a few pivots; then documents
outside the cluster's largest part meet every block whose bounding box can
reach them. Pairs already connected are not compared again, which leaves the
components as they are.

Defined results: null and empty texts have an empty set and link to nothing;
with fewer words than ``size`` the whole sequence is the one shingle. Repeated
rows (equal id and text) are one document; rows with equal id and other texts
are told apart, and a null id counts as greater than any. Extra columns are
ignored by ``near_duplicates`` and carried through by ``keep_first``. Shingles
are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from adloom.llm import bloom
from adloom.llm.components import components
from adloom.llm.words import mix, shingles, slices, word_hashes
from adloom.llm.workspace import Workspace, spare_name

#: Coordinates of a point: the noise of counts needs more groups in larger sets. (Least size, groups), powers of two.
GROUPS = ((0, 64), (819, 256), (6553, 1024))
LEAST_GROUPS = GROUPS[0][1]
#: Points below one node of the tree.
LEAF = 32
#: Rows of one key that are compared pair by pair rather than in a tree.
FEW = 8
#: Below this many hashes, a range is a single hash.
SINGLE = 32


# --- one document -----------------------------------------------------------------


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, at = word_hashes(texts)
    for i in range(len(texts)):
        yield np.unique(shingles(words[at[i] : at[i + 1]], size))


def groups_of(size: int) -> int:
    return next(g for least, g in reversed(GROUPS) if size >= least)


def packed_point(hashes: np.ndarray) -> bytes:
    """How many of the hashes fall into each group (by their lowest bits), up to 255, a byte each."""
    groups = groups_of(len(hashes))
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def points_of(packed: list[bytes], sizes: np.ndarray, groups: int | None = None) -> np.ndarray:
    """Points as rows of counts, and the hashes above 255 of a group; in ``groups`` groups or as many as all have.

    Groups go by the lowest bits of a hash, so fewer groups are sums of more.
    """
    lengths = np.array([len(p) for p in packed])
    groups = groups or int(lengths.min())
    out = np.empty((len(packed), groups + 1), np.int32)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        counts = np.frombuffer(b"".join([packed[i] for i in at]), np.uint8).reshape(len(at), length // groups, groups)
        out[at, :groups] = counts.sum(1, dtype=np.int32)
    out[:, groups] = sizes - out[:, :groups].sum(1)
    return out


def set_key(hashes: np.ndarray) -> int:
    """One 64-bit key of a set."""
    return int(mix(np.array([hashes.sum() ^ (mix(hashes ^ np.uint64(0x5EED)).sum() << np.uint64(1)) + np.uint64(len(hashes))]))[0].view(np.int64))


def needed(a, b, percent: int):
    """Least overlap that links sets of sizes a and b: 100 * overlap >= percent * (a + b - overlap)."""
    return -(-percent * (a + b) // (100 + percent))


def _ranges(level: int, percent: int) -> int:
    """Ranges of the hash space in the size class [2^level, 2^(level+1)); 0: every hash is its own range."""
    top = 1 << (level + 1)
    if top <= SINGLE:
        return 0
    differ = (100 - percent) * top // percent
    # Enough that far more than r + 1 ranges hold a hash, however the hashes fall; few, as a range of many hashes tells more.
    return (differ + 1) * (200 if top <= 4 * SINGLE else 150 if top <= 16 * SINGLE else 115) // 100


def route_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the first r + 1 ranges that hold a hash, in every size class where the document may have a partner."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    differ = (100 - percent) * n // percent
    own = n.bit_length() - 1
    out = []
    for level in range(own, (100 * n // percent).bit_length()):
        count = _ranges(level, percent)
        salt = np.uint64((level + 1) << 32)
        if count == 0:
            out.append(mix(hashes[: differ + 1] + salt))
            continue
        # Equal ranges of the top 32 bits.
        where = ((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        begins = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        ends = np.append(begins[1:], n)[: differ + 1]
        begins = begins[: differ + 1]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(hashes), out=sums[1:])
        out.append(mix((sums[ends] - sums[begins]) + mix(where[begins] + salt)))
    return np.concatenate(out)


# --- the tree ----------------------------------------------------------------------


class RTree:
    """Points packed into leaves along (size, widest coordinates), and two levels of bounding boxes above."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = tree_order(points, sizes)
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.leaf = self._boxes(self.points, self.sizes, self.sizes)
        self.root = self._boxes(self.leaf[0], self.leaf[1], self.leaf[2])

    @staticmethod
    def _boxes(high: np.ndarray, least: np.ndarray, most: np.ndarray):
        at = np.arange(0, len(high), LEAF)
        return np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)

    @staticmethod
    def _reached(boxes, nodes: np.ndarray, p: np.ndarray, n: int, percent: int) -> np.ndarray:
        high, least, most = (b[nodes] for b in boxes)
        # Sizes that can link at all, and the overlap that the smallest partner of the box would ask for.
        fits = (100 * np.minimum(most, n) >= percent * np.maximum(least, n)) & (100 * n >= percent * least)
        bound = np.minimum(high, p).sum(1)
        return nodes[fits & (bound >= needed(n, np.maximum(least, -(-percent * n // 100)), percent))]

    def search(self, p: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Places (in the tree's order) of the points whose overlap with (p, n) may be enough."""
        nodes = self._reached(self.root, np.arange(len(self.root[1])), p, n, percent)
        nodes = self._reached(self.leaf, _below(nodes, len(self.leaf[1])), p, n, percent)
        rows = _below(nodes, len(self.sizes))
        sizes = self.sizes[rows]
        close = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))
        rows, sizes = rows[close], sizes[close]
        return rows[np.minimum(self.points[rows], p).sum(1) >= needed(n, sizes, percent)]


def _below(nodes: np.ndarray, count: int) -> np.ndarray:
    rows = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
    return rows[rows < count]


def tree_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slabs of nearly equal size, each sorted by the coordinates that vary most, coarsely first."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    slab = (np.log2(np.maximum(sizes, 1)) * 8).astype(np.int64)
    wide = np.argsort(-points.var(0), kind="stable")[:3]
    step = 1 + points[:, wide].max(0) // 16
    coarse = points[:, wide] // step
    return np.lexsort((points[:, wide[0]], *coarse.T[::-1], slab))


class Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_block(
    points: np.ndarray, sizes: np.ndarray, percent: int, sets: list[np.ndarray] | None = None, first: int = 0
) -> list[tuple[int, int]]:
    """Links that connect what is connected: among all points, or, if first > 0, between the first ones and the others.

    Without ``sets`` every pair whose points allow a link counts as one. The
    search begins at the middle of all points: what is in its part by the time
    of its turn needs no search, as whatever links to it from outside finds it.
    """
    tree, union, out = RTree(points, sizes), Union(len(sizes)), []
    middle = -1 if first else int(np.abs(points - np.median(points, 0)).sum(1).argmin())
    done = np.zeros(len(sizes), bool)
    for i in range(first) if first else [middle, *range(len(sizes))]:
        if done[i] or (i != middle and middle >= 0 and union.find(i) == union.find(middle)):
            continue
        done[i] = True
        for place in tree.search(points[i], int(sizes[i]), percent):
            j = int(tree.order[place])
            if j == i or (j < first if first else done[j]) or union.find(i) == union.find(j):
                continue
            if sets is None or linked(sets[i], sets[j], percent):
                union.join(i, j)
                out.append((i, j))
    return out


# --- Spark -------------------------------------------------------------------------


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), _long(flat))


def _list_values(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column)).astype(np.int64))])
    return [flat[ends[i] : ends[i + 1]] for i in range(len(column))]


def row_key(doc_id: str, text: str):
    return F.xxhash64(F.col(doc_id), F.col(text))


def _signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(k, doc_id, n, node, point, keys) of every row; ``node`` is the key of the set, null if it is empty.

    Of equal sets in one task only the first has its point and keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for batch in batches:
            for part in slices(batch, "text"):
                sets = list(shingle_sets(part.column(2), size))
                nodes = [set_key(s) if len(s) else None for s in sets]
                new = [node not in seen and not seen.add(node) for node in nodes]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array([packed_point(s) if ok else None for s, ok in zip(sets, new)], pa.binary()),
                        _lists([route_keys(s if ok else s[:0], percent) for s, ok in zip(sets, new)]),
                    ],
                    ["k", "doc_id", "n", "node", "point", "keys"],
                )

    return docs.mapInArrow(run, "k long, doc_id long, n long, node long, point binary, keys array<long>")


def _candidate_edges(signatures: DataFrame, space: Workspace, percent: int, block: int) -> DataFrame:
    """(a, b): edges that connect all nodes that share a key and whose points allow a link.

    The nodes of a key with more than ``block`` rows are too many for one tree:
    all of them are candidates, as a star, and no task ever holds them.
    """
    one = signatures.where("point IS NOT NULL")
    rows = one.select(F.explode("keys").alias("key"), "node")
    # Summed up before the shuffle: equal sets and common keys cost one row per task.
    shared = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count(F.lit(1)).alias("rows"))
    shared = shared.where("least <> most").withColumn("head", F.when(F.col("rows") > block, F.col("least"))).select("key", "head")
    met = space.stage(rows.join(shared, "key").distinct(), "met")
    stars = met.where("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b"))
    met = met.where("head IS NULL").select("key", "node")
    points = one.groupBy("node").agg(F.first("n").alias("n"), F.first("point").alias("point"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last key, which may go on in the next batch
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(3)]
            rows.append(np.array([*batch.column(3).to_pylist(), None], object)[:-1])
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                held = None
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            yield from _edge_batches(*_meet([x[:last] for x in rows], percent))
            held = [x[last:] for x in rows]
        if held is not None:
            yield from _edge_batches(*_meet(held, percent))

    dealt = met.join(points, "node").select("key", "node", "n", "point")
    dealt = dealt.repartition(_partitions(signatures.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long").unionAll(stars).distinct()


def _meet(rows: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges among the rows (key, node, n, packed point) of each of the whole keys given, sorted by key."""
    key, node, n, packed = rows
    if not len(key):
        return node, node
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(begin, len(key)))
    of_row = np.repeat(count, count)
    # Few rows: their pairs, each once however many keys it shares.
    pairs = []
    for step in range(1, FEW):
        at = np.flatnonzero((key[step:] == key[:-step]) & (of_row[step:] <= FEW))
        pairs.append(np.column_stack([at, at + step]))
    pairs = np.concatenate(pairs)
    a, b = node[pairs[:, 0]], node[pairs[:, 1]]
    _, fresh = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0, return_index=True)
    pairs = pairs[fresh]
    coarse, good = points_of(packed, n, LEAST_GROUPS), []
    for low in range(0, len(pairs), 1 << 15):
        i, j = pairs[low : low + (1 << 15)].T
        close = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        good.append(close & (np.minimum(coarse[i], coarse[j]).sum(1) >= needed(n[i], n[j], percent)))
    pairs = pairs[np.concatenate(good)] if good else pairs
    fine = [len(packed[i]) == LEAST_GROUPS or len(packed[j]) == LEAST_GROUPS or _allows(packed, n, i, j, percent) for i, j in pairs]
    pairs = pairs[np.array(fine, bool)]
    out = [np.column_stack([node[pairs[:, 0]], node[pairs[:, 1]]])]
    for low, m in zip(begin[count > FEW], count[count > FEW], strict=True):
        own = slice(low, low + m)
        found = join_block(points_of(packed[own], n[own]), n[own], percent)
        out += [node[own][np.array(found)]] if found else []
    edges = np.concatenate(out)
    return edges[:, 0], edges[:, 1]


def _allows(packed: np.ndarray, n: np.ndarray, i: int, j: int, percent: int) -> bool:
    at = [i, j]
    return np.minimum(*points_of(packed[at], n[at])).sum() >= needed(n[i], n[j], percent)


def _edge_batches(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _stream_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[int], list[np.ndarray], list[bool]]]:
    """Groups of rows (g, half, node, hashes) that arrive sorted by g; one group is held at a time."""
    now, nodes, sets, halves = None, [], [], []
    for batch in batches:
        g, half, node = (batch.column(i).to_pylist() for i in range(3))
        for i, s in enumerate(_list_values(batch.column(3))):
            if g[i] != now:
                if now is not None:
                    yield now, nodes, sets, halves
                now, nodes, sets, halves = g[i], [], [], []
            nodes.append(node[i])
            sets.append(s)
            halves.append(half[i])
    if now is not None:
        yield now, nodes, sets, halves


def _links(groups: DataFrame, percent: int, partitions: int) -> DataFrame:
    """Links (a, b) within every group of rows (g, half, node, hashes); with halves, only between half 0 and half 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, nodes, sets, halves in _stream_groups(batches):
            first = sum(h == 0 for h in halves) if any(halves) else 0
            if any(halves) and not first:
                continue
            sizes = np.array([len(s) for s in sets])
            points = points_of([packed_point(s) for s in sets], sizes)
            pairs = join_block(points, sizes, percent, sets, first)
            if pairs:
                yield from _edge_batches(*np.array(nodes, np.int64)[np.array(pairs)].T)

    dealt = groups.select("g", "half", "node", "hashes").repartition(partitions, "g").sortWithinPartitions("g", "half")
    return dealt.mapInArrow(run, "a long, b long")


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions")) * 4


def _member_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(node, hashes) of one row of every node of ``members`` (node, k)."""
    known = bloom.build(members.select("k"), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                some = bloom.maybe(known, part.column(0).to_numpy().view(np.uint64))
                part = part.filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(list(shingle_sets(part.column(2), size)))], ["k", "hashes"])

    made = docs.mapInArrow(run, "k long, hashes array<long>")
    return made.join(members, "k").select("node", "hashes").dropDuplicates(["node"])


def link_nodes(sets: DataFrame, space: Workspace, percent: int, block: int, pivots: int = 64) -> DataFrame:
    """Links (a, b) among the rows (cluster, node, hashes): all that is needed to know the components."""
    partitions = _partitions(space.spark)
    sizes = space.stage(sets.groupBy("cluster").count(), "cluster-sizes")
    small = sets.join(sizes.where(F.col("count") <= block), "cluster")
    links = _links(small.select(F.col("cluster").cast("string").alias("g"), F.lit(0).alias("half"), "node", "hashes"), percent, partitions)
    large = sizes.where(F.col("count") > block)
    if large.isEmpty():
        return links

    # Blocks along the tree's order: by size, then by the counts of the first groups.
    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _list_values(batch.column(2))
            points = [points_of([packed_point(s)], np.array([len(s)]), LEAST_GROUPS)[0].astype(np.uint64) for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(points)], ["cluster", "node", "hashes", "point"])

    big = sets.join(large, "cluster").select("cluster", "node", "hashes")
    big = space.stage(big.mapInArrow(boxes, "cluster long, node long, hashes array<long>, point array<long>"), "large")
    # Documents of a large cluster are told apart by slabs of size; each slab is spread over enough blocks.
    slab = F.floor(F.log2(F.size("hashes")) * 8).cast("int")
    slabs = big.groupBy("cluster", slab.alias("slab")).agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    spread = big.withColumn("slab", slab).join(slabs, ["cluster", "slab"])
    spread = spread.withColumn("block", F.concat_ws("/", "slab", F.pmod(F.xxhash64("node"), F.col("parts"))))
    spread = space.stage(spread.select("cluster", "block", "node", "hashes", "point"), "blocks")
    order = Window.partitionBy("cluster").orderBy("node")
    # The pivots: a few of the largest clusters' documents each, cut per task before the shuffle.
    chosen = spread.select("cluster", "node", "hashes").withColumn("i", F.row_number().over(order)).where(F.col("i") <= pivots)
    chosen = space.stage(chosen.drop("i"), "pivots")

    def with_block(rows: DataFrame, half: int) -> DataFrame:
        g = F.concat_ws(":", "cluster", "block")
        return rows.select(g.alias("g"), F.lit(half).alias("half"), "node", "hashes")

    names = spread.select("cluster", "block").distinct()
    to_pivots = with_block(chosen.join(names, "cluster"), 0).unionAll(with_block(spread, 1))
    inside = with_block(spread, 0).withColumn("g", F.concat(F.lit("in:"), "g"))
    found = space.stage(_links(inside.unionAll(to_pivots), percent, partitions), "links-1")

    # What is not in its cluster's largest part meets every block that can reach it.
    parts = components(found, space, "parts").withColumnRenamed("root", "part")
    placed = spread.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    placed = space.stage(placed, "placed")
    counts = placed.groupBy("cluster", "part").count()
    best = counts.groupBy("cluster").agg(F.max_by("part", F.struct("count", "part")).alias("main"))
    rest = placed.join(best, "cluster").where("part <> main").select("cluster", "block", "node", "hashes", "point")
    rest = space.stage(rest, "rest")
    high = [F.max(F.col("point")[i]).alias(f"h{i}") for i in range(LEAST_GROUPS + 1)]
    bounds = spread.groupBy("cluster", "block").agg(
        F.min(F.size("hashes")).alias("least"), F.max(F.size("hashes")).alias("most"), *high
    )
    bounds = bounds.select(
        "cluster", F.col("block").alias("other"), "least", "most", F.array(*[f"h{i}" for i in range(LEAST_GROUPS + 1)]).alias("high")
    )
    n = F.size("hashes")
    overlap = F.aggregate(F.zip_with("point", "high", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda x, y: x + y)
    least = F.greatest(F.col("least"), F.ceil(percent * n / 100))
    reach = (100 * F.least("most", n) >= percent * F.greatest("least", n)) & (
        (100 + percent) * overlap >= percent * (n + least)
    )
    calls = rest.join(bounds, "cluster").where((F.col("block") != F.col("other")) & reach)
    # Callers of one block, in groups of ``block`` at most.
    crowd = calls.groupBy("cluster", "other").agg(F.ceil(F.count(F.lit(1)) / block).alias("crowds"))
    calls = calls.join(crowd, ["cluster", "other"]).withColumn("crowd", F.pmod(F.xxhash64("node"), F.col("crowds")))
    callers = calls.select(F.concat_ws(":", "cluster", "other", "crowd").alias("g"), F.lit(0).alias("half"), "node", "hashes")
    hosts = spread.join(crowd.withColumnRenamed("other", "block"), ["cluster", "block"]).select(
        F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("crowd"), "cluster", "block", "node", "hashes"
    )
    hosts = hosts.select(F.concat_ws(":", "cluster", "block", "crowd").alias("g"), F.lit(1).alias("half"), "node", "hashes")
    return links.unionAll(found).unionAll(_links(callers.unionAll(hosts), percent, partitions))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, block: int = 2000
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its set, and the smallest id that links reach."""
    return _components(docs, doc_id, text, size, percent, block).select("doc_id", "n_shingles", "component_id")


def keep_first(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, block: int = 2000
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the smallest id; empty texts all stay."""
    key = spare_name(docs, "_key")
    found = _components(docs, doc_id, text, size, percent, block)
    kept = found.where("first").select(F.col("k").alias(key)).distinct()
    has_words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = docs.where(has_words).withColumn(key, row_key(doc_id, text)).join(kept, key, "left_semi")
    return chosen.dropDuplicates([key]).drop(key).unionByName(docs.where(~has_words))


def _components(docs, doc_id, text, size, percent, block) -> DataFrame:
    """(k, doc_id, n_shingles, component_id, component, first) of every row; the component of an empty set is null."""
    space = Workspace(docs.sparkSession, "ngram-join")
    texts = docs.select(row_key(doc_id, text).alias("k"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signatures = space.stage(_signatures(texts, size, percent), "signatures")
    clusters = components(_candidate_edges(signatures, space, percent, block), space, "clusters")
    clusters = clusters.unionAll(clusters.select(F.col("root").alias("node"), "root").distinct())
    clusters = space.stage(clusters.withColumnRenamed("root", "cluster"), "members")

    nodes = space.stage(signatures.drop("keys", "point"), "nodes")
    space.drop("signatures")
    space.drop("met")
    named = nodes.where("node IS NOT NULL").groupBy("node").agg(F.min("k").alias("k"))
    members = space.stage(clusters.join(named, "node"), "clusters")
    sets = _member_sets(texts, members.select("node", "k"), size)
    sets = space.stage(sets.join(members.select("node", "cluster"), "node").select("cluster", "node", "hashes"), "sets")
    links = space.stage(link_nodes(sets, space, percent, block), "links")
    roots = components(links, space, "groups").select("node", F.col("root").alias("component"))
    rows = nodes.join(roots, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = space.stage(rows, "rows")
    space.keep_only("rows")
    # A null id is greater than any, so a group of such rows only has one of them as its first.
    firsts = rows.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("f")
    )
    joined = rows.join(firsts, "component", "left")
    return joined.select(
        "k",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("f.doc_id")).alias("component_id"),
        "component",
        (F.col("k") == F.col("f.k")).alias("first"),
    )
