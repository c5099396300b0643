"""Exact dedup by Grace hashing: records go to buckets until each bucket fits an open-addressing table of whole contents.

Texts are equal when they are identical after every run of ASCII white space
has become one space; a null text counts as empty.

1. Every task first collapses what it reads: a window of rows goes through a
   bounded table, and of equal texts one representative keeps its content. So a
   text that a third of all rows share is shuffled once per window.
2. Representatives are dealt to buckets by a hash of their content. Spark's
   shuffle holds them as files, sorted by bucket, and one table after the other
   takes a bucket. Its slots are probed one by one, and only equal content is a
   match, whatever the hashes say.
3. A bucket that does not fit its table is written out again, each text once
   per table filled, and dealt anew by another hash: the next level. So is a
   text with very many representatives, whose copies are dealt to several
   tables first. Levels end when every bucket fitted.
4. Rows follow their representatives to the row that stays.

Of equal texts the row with the smallest id stays; null ids come last, and of
rows that share an id and a text exactly one stays.

Defined results: null and empty texts are one group, and so are texts of white
space only (they become one space); long texts are compared whole, and one
longer than a table has a table of its own. Repeated ids are judged row by row.
An empty table gives no rows. ``drop_copies`` carries all columns untouched,
whatever their names; ``groups`` returns its own columns only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adloom.llm.workspace import Workspace, spare_name

WHITE = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Settings:
    #: Content that one table holds before it counts as full.
    table_bytes: int = 32 << 20
    #: Rows that one table remembers before it counts as full.
    table_rows: int = 1 << 18
    #: Representatives of one hash that go to one table; more are dealt to several tables first.
    few: int = 1024
    #: Partitions of one shuffle; there may be more buckets.
    most_partitions: int = 20000
    #: Levels after which a run gives up; each has a hash of its own.
    most_levels: int = 40


COLLAPSED = "uid long, id long, into long, n long, n_bytes long, h long, sha binary, content binary"
LEVEL = "uid long, into long, open boolean, id long, n long, n_bytes long, h long, sha binary, content binary"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


class Table:
    """Open addressing with linear probing over whole contents; half of the slots stay free."""

    def __init__(self):
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.held = 0

    def _probe(self, h: int, content: bytes) -> tuple[int, int]:
        """The slot where the search for ``content`` ends, and its entry, or -1."""
        at = h & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                break
            at = (at + 1) & self.mask
        return at, entry

    def holds(self, h: int, content: bytes) -> bool:
        return self._probe(h, content)[1] >= 0

    def place(self, h: int, content: bytes) -> int:
        """The entry of ``content``, which is added if new."""
        at, entry = self._probe(h, content)
        if entry >= 0:
            return entry
        entry = self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.held += len(content)
        if 2 * len(self.contents) > self.mask:
            self._grow()
        return entry

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry


class Bucket:
    """The rows of one filling of a table, and which of them represents each content."""

    def __init__(self, s: Settings):
        self.s = s
        self.table = Table()
        self.rows: list[tuple[int, int]] = []  # uid, entry
        self.best: list[tuple] = []  # of each entry: (id is null, id, uid)
        self.counts: list[int] = []
        self.digests: list[bytes | None] = []

    def fits(self, h: int, content: bytes) -> bool:
        if not self.rows:
            return True
        if len(self.rows) >= self.s.table_rows:
            return False
        return self.table.held + len(content) <= self.s.table_bytes or self.table.holds(h, content)

    def add(self, uid: int, key: int | None, h: int, content: bytes, n: int, sha: bytes | None) -> None:
        entry = self.table.place(h, content)
        rank = (key is None, key, uid)
        if entry == len(self.best):
            self.best.append(rank)
            self.counts.append(n)
            self.digests.append(sha)
        else:
            self.best[entry] = min(self.best[entry], rank, key=lambda r: (r[0], r[1] or 0, r[2]))
            self.counts[entry] += n
        self.rows.append((uid, entry))


def _batches(rows: Iterable[dict], schema: pa.Schema, most_rows: int = 4000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("content") or b"")
        if len(held) >= most_rows or size >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _collapse(s: Settings):
    """Rows (uid, id, h, content) to COLLAPSED: representatives have a content, the others point to one."""
    schema = _arrow(COLLAPSED)

    def emptied(bucket: Bucket, ids: list) -> Iterator[dict]:
        for (uid, entry), key in zip(bucket.rows, ids):
            root = bucket.best[entry][2]
            row = {"uid": uid, "id": key, "into": root}
            if uid == root:
                content = bucket.table.contents[entry]
                row |= {"n": bucket.counts[entry], "n_bytes": len(content), "h": bucket.table.hashes[entry]}
                row |= {"sha": hashlib.sha256(content).digest(), "content": content}
            yield row

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bucket, ids = Bucket(s), []
        for batch in batches:
            for uid, key, h, content in zip(*[c.to_pylist() for c in batch.columns]):
                if not bucket.fits(h, content):
                    yield from emptied(bucket, ids)
                    bucket, ids = Bucket(s), []
                bucket.add(uid, key, h, content, 1, None)
                ids.append(key)
        yield from emptied(bucket, ids)

    return lambda batches: _batches(rows(batches), schema)


def _resolve(s: Settings):
    """Representatives sorted by (bucket, salt) to LEVEL: resolved where the bucket fitted one table, else open."""
    schema = _arrow(LEVEL)

    def emptied(bucket: Bucket, open_: bool) -> Iterator[dict]:
        for uid, entry in bucket.rows:
            null, key, root = bucket.best[entry]
            row = {"uid": uid, "into": root, "open": open_}
            if not open_ or uid == root:
                row |= {"id": key, "n": bucket.counts[entry], "sha": bucket.digests[entry]}
            if open_ and uid == root:
                content = bucket.table.contents[entry]
                row |= {"n_bytes": len(content), "h": bucket.table.hashes[entry], "content": content}
            yield row

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bucket, name, full = Bucket(s), None, False
        for batch in batches:
            for number, salt, uid, key, n, h, sha, content in zip(*[c.to_pylist() for c in batch.columns]):
                if (number, salt) != name:
                    yield from emptied(bucket, full)
                    # Dealt copies of one text meet again at the next level.
                    bucket, name, full = Bucket(s), (number, salt), salt >= 0
                elif not bucket.fits(h, content):
                    full = True
                    yield from emptied(bucket, full)
                    bucket = Bucket(s)
                bucket.add(uid, key, h, content, n, sha)
        yield from emptied(bucket, full)

    return lambda batches: _batches(rows(batches), schema)


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def _level(todo: DataFrame, level: int, space: Workspace, s: Settings) -> DataFrame:
    """One level over the representatives ``todo``, a staged table with the columns of COLLAPSED but ``into``."""
    size, count = todo.agg(F.sum("n_bytes"), F.count("uid")).first()
    buckets = max(1, math.ceil(2 * (size or 0) / s.table_bytes), math.ceil(2 * count / s.table_rows))
    hot = space.stage(todo.groupBy("h").count().where(F.col("count") > s.few), f"hot-{level}")
    dealt = todo.withColumn("salt", F.lit(-1).cast("long"))
    if not hot.isEmpty():  # at most one in ``few`` of the hashes, so small that Spark rarely shuffles for it
        parts = F.ceil(F.col("count") / s.few)
        dealt = todo.join(hot, "h", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("uid"), parts), F.lit(-1).cast("long")))
    dealt = dealt.select(
        F.pmod(F.xxhash64(F.lit(level), "content"), F.lit(buckets)).alias("bucket"), "salt", "uid", "id", "n", "h", "sha", "content"
    )
    # Buckets are of one size, so each has its own partition as far as there are partitions; shares of a hot text spread over all.
    partition = F.pmod(F.col("bucket") + F.col("salt") + 1, F.lit(min(buckets, s.most_partitions))).cast("int")
    dealt = dealt.repartitionById(min(buckets, s.most_partitions), partition).sortWithinPartitions("bucket", "salt")
    return space.stage(dealt.mapInArrow(_resolve(s), LEVEL), f"level-{level}")


def _joined(docs: DataFrame, doc_id: str, text: str, s: Settings) -> DataFrame:
    """(id, root, uid, keep_id, n, sha) of every row."""
    space = Workspace(docs.sparkSession, "grace-dedup")
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc_id}`").cast("long").alias("id"), _normal(F.col(f"`{text}`")).alias("t")
    )
    rows = rows.select("uid", "id", F.xxhash64("t").alias("h"), F.col("t").cast("binary").alias("content"))
    collapsed = space.stage(rows.mapInArrow(_collapse(s), COLLAPSED), "collapsed")

    levels = []
    todo = collapsed.where(F.col("content").isNotNull()).drop("into")
    while True:
        if len(levels) == s.most_levels:
            raise RuntimeError(f"buckets did not fit in {s.most_levels} levels")
        done = _level(todo, len(levels), space, s)
        levels.append(done)
        todo = done.where("open AND content IS NOT NULL").drop("into", "open")
        if todo.select("uid").isEmpty():
            break

    space.keep_only("collapsed", *[f"level-{k}" for k in range(len(levels))])
    found = None
    for done in reversed(levels):
        here = done.where("NOT open").select("uid", F.col("into").alias("root"), F.col("id").alias("keep_id"), "n", "sha")
        if found is not None:
            passed = done.where("open").select(F.col("uid").alias("from"), F.col("into").alias("uid"))
            passed = passed.join(found, "uid").select(F.col("from").alias("uid"), "root", "keep_id", "n", "sha")
            here = here.unionByName(passed)
        found = here
    members = collapsed.select(F.col("uid").alias("row"), "id", F.col("into").alias("uid"))
    return members.join(found, "uid").select("id", "root", F.col("row").alias("uid"), "keep_id", "n", "sha")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings()) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the digest is that of the text with single spaces."""
    return _joined(docs, doc_id, text, s).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("uid") == F.col("root")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = groups(docs, doc_id, text, s).where("kept").select("doc_id", "text_sha256")
    sha, order, key = (spare_name(docs, n) for n in ("_sha", "_order", "_id"))
    keyed = docs.withColumn(sha, F.sha2(_normal(F.col(f"`{text}`")).cast("binary"), 256)).withColumn(key, F.col(f"`{doc_id}`").cast("long"))
    found = found.select(F.col("doc_id").alias(f"{key}_kept"), F.col("text_sha256").alias(f"{sha}_kept"))
    same = (F.col(sha) == F.col(f"{sha}_kept")) & F.col(key).eqNullSafe(F.col(f"{key}_kept"))
    stay = keyed.join(found, same, "left_semi")
    # Rows that share id and text are cut to one here; no other rows share this key.
    first = F.row_number().over(Window.partitionBy(sha, key).orderBy(sha))
    return stay.withColumn(order, first).where(F.col(order) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
