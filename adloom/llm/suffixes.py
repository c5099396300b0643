"""Removal of repeated byte strings by a distributed, common-prefix-aware suffix sort.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere
else, in any document, is removed.

* Every window of ``LENGTH`` bytes has an anchor: the position of its smallest
  ``GRAM``-byte hash. Equal windows have it at the same place, so a window can
  only repeat if its anchor's gram does. Windows of one anchor are adjacent;
  the bytes they span are the anchor's context. An anchor whose whole context
  occurs twice is settled: all its windows repeat.
* Where a gram has several contexts, the suffixes that begin at its anchors are
  sorted: every task sorts its own, front-codes them (length shared with the
  one before, and the rest) and sends each stretch between splitters to one
  place, where a loser tree merges the runs. The tree carries the prefix that a
  candidate shares with the last suffix put out and never compares it again.
  What lies before the anchors is sorted in the same way, read backwards.
* The longest prefixes shared with a neighbour bound what any window of the
  anchor can share to the right and to the left, so only windows within both
  bounds are left. Their hashes meet by key, and those that occur twice are
  removed.

Texts stay where they are but for documents that have something to compare or
to remove. Common strings are summed up in each task before every shuffle, and
a common suffix reaches the merge once per run.

Defined results: a null text is empty; matches never cross documents; texts of
fewer than ``LENGTH`` bytes keep everything. Rows are told apart by id and text:
a repeated row (equal id and text) repeats its strings, so both lose them.
Extra columns are ignored. Contexts and windows are told apart by 64-bit hashes
within one gram's 64-bit hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adloom.llm import bloom
from adloom.llm.sampling import smallest
from adloom.llm.words import mix, powers, slices, span_hashes, text_bytes
from adloom.llm.workspace import Workspace

LENGTH = 400
GRAM = 160
#: Bytes of texts worked on at once.
PIECE = 1 << 19
#: Parts that the contexts of a gram are dealt to.
SALTS = 16
#: Suffixes of one sorted run.
RUN = 50_000
#: Suffixes that the driver samples to choose splitters: so many at least, and so many for each range.
SAMPLE, PER_RANGE = 4096, 4


# --- anchors -------------------------------------------------------------------------


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for every i with a full window."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    n = len(raw) - size + 1
    return mix((sums[size:] - sums[:n]) * down[:n])


def anchors(raw: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, anchor, first window, last window, gram's hash, context's hash) of every anchor of the texts in ``raw``."""
    width = length - gram + 1
    found = []
    limits = starts[1:] - length  # last window's start in each text
    for low in range(0, max(0, len(raw) - length + 1), PIECE):
        piece = raw[low : low + PIECE + length - 1]
        hashes = _gram_hashes(piece, gram)
        keyed = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        at = (_sliding_least(keyed, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        begins = np.arange(low, low + len(at))
        text = np.searchsorted(starts, begins[[0, -1]], "right") - 1
        borders = np.clip(starts[text[0] : text[1] + 2] - low, 0, len(at))
        limit = np.repeat(limits[text[0] : text[1] + 1], np.diff(borders))
        owner = np.repeat(np.arange(text[0], text[1] + 1), np.diff(borders))
        fits = begins <= limit
        begins, at, owner = begins[fits], at[fits], owner[fits]
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(at)) - 1
        found.append((owner[head], at[head] + low, begins[head], begins[last], hashes[at[head]]))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    owner, anchor, first, last, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    # An anchor whose windows were cut by a piece's end is one again.
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    last = last[np.append(head[1:], len(anchor)) - 1]
    owner, anchor, first, hashes = owner[head], anchor[head], first[head], hashes[head]
    context = span_hashes(raw, first, last + length, lower=False)
    context = mix(context + mix((anchor - first).astype(np.uint64) << np.uint64(20) | (last - first).astype(np.uint64)))
    return owner, anchor, first, last, hashes, context


# --- the sort ------------------------------------------------------------------------


def shared_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    most = min(len(a), len(b))
    step = 16
    while start < most:
        end = min(most, start + step)
        if a[start:end] != b[start:end]:
            while end - start > 1:
                middle = (start + end) // 2
                if a[start:middle] == b[start:middle]:
                    start = middle
                else:
                    end = middle
            return start
        start, step = end, step * 2
    return most


def front_code(run: list[tuple[bytes, bool]]) -> bytes:
    """A sorted run of distinct suffixes, each as the prefix shared with the one before, and the rest."""
    lcps, tails = np.zeros(len(run), np.uint16), []
    before = b""
    for i, (s, _) in enumerate(run):
        lcps[i] = shared_prefix(before, s) if i else 0
        tails.append(s[lcps[i] :])
        before = s
    sizes = np.array([len(t) for t in tails], np.uint16)
    many = np.array([m for _, m in run], np.uint8)
    return b"".join([np.int64(len(run)).tobytes(), lcps.tobytes(), sizes.tobytes(), many.tobytes(), *tails])


def read_run(blob: bytes) -> Iterator[tuple[int, bytes, bool]]:
    """(prefix shared with the one before, suffix, whether the run had it more than once)."""
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    lcps = np.frombuffer(blob, np.uint16, n, 8).tolist()
    sizes = np.frombuffer(blob, np.uint16, n, 8 + 2 * n).tolist()
    many = np.frombuffer(blob, np.uint8, n, 8 + 4 * n).tolist()
    at, s = 8 + 5 * n, b""
    for lcp, size, m in zip(lcps, sizes, many, strict=True):
        s = s[:lcp] + blob[at : at + size]
        at += size
        yield lcp, s, bool(m)


class LoserTree:
    """Merges sorted runs. Every loser knows what it shares with the winner that beat it, which is never compared again."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, bool]]]):
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads: list[tuple[bytes, bool] | None] = [None] * self.size
        self.lcps = [0] * self.size
        for i in range(len(runs)):
            self.advance(i)
            self.lcps[i] = 0
        self.losers = [0] * self.size
        self.winner = self._play(1)

    def advance(self, i: int) -> None:
        lcp, s, many = next(self.runs[i], (0, None, False))
        self.heads[i], self.lcps[i] = None if s is None else (s, many), lcp

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = self.match(a, b)
        return winner

    def match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two candidates whose shared prefixes are with the same suffix."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if self.lcps[a] != self.lcps[b]:
            return (a, b) if self.lcps[a] > self.lcps[b] else (b, a)
        h = shared_prefix(x[0], y[0], self.lcps[a])
        first = x[0][h : h + 1] <= y[0][h : h + 1]
        winner, loser = (a, b) if first else (b, a)
        self.lcps[loser] = h
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, bool]]:
        while (head := self.heads[self.winner]) is not None:
            yield self.lcps[self.winner], *head
            now = self.winner
            self.advance(now)
            node = (now + self.size) // 2
            while node:
                now, self.losers[node] = self.match(now, self.losers[node])
                node //= 2
            self.winner = now


def longest_shared(merged: Iterator[tuple[int, bytes, bool]], low: bytes | None, high: bytes | None) -> Iterator[tuple[bytes, int]]:
    """(suffix, longest prefix it shares with any other) of every distinct suffix, in order.

    ``low`` and ``high``: the splitters around; what lies beyond shares no more than they do.
    """
    before, best = None, 0
    for lcp, s, many in merged:
        if before is None:
            before, best = s, shared_prefix(low, s) if low else 0
        elif lcp == len(s) == len(before):
            best = len(s)
        else:
            yield before, max(best, lcp)
            before, best = s, lcp
        if many:
            best = len(s)
    if before is not None:
        yield before, max(best, shared_prefix(before, high) if high else 0)


def suffix_key(s: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(s, digest_size=8).digest(), "little", signed=True)


def sorted_bounds(suffixes: DataFrame, column: str, range_bytes: int = 32 << 20) -> DataFrame:
    """(key, shared): of every distinct value of a binary column, the longest prefix shared with another row's.

    The driver sees about 2 KB of suffixes for each ``range_bytes`` of them, and a merge one range at a time.
    """
    suffixes = suffixes.select(F.col(column).alias("s"), F.xxhash64(column, "rid").alias("h"))
    size = suffixes.agg(F.sum(F.length("s"))).first()[0] or 0
    ranges = max(1, -(-size // range_bytes), min(64, -(-size // (1 << 20))))
    sample = sorted({bytes(r.s) for r in smallest(suffixes, F.col("h"), max(SAMPLE, PER_RANGE * ranges)).collect()}) if ranges > 1 else []
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else set())

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, bool] = {}

        def send():
            order = sorted(held)
            cuts = [0, *(bisect_left(order, s) for s in splitters), len(order)]
            rows = [(r, front_code([(s, held[s]) for s in order[a:b]])) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            held.clear()
            columns = [pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["range", "run"])

        for batch in batches:
            for s in batch.column(0).to_pylist():
                held[s] = s in held
                if len(held) >= RUN:
                    yield send()
        if held:
            yield send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(r: int, blobs: list[bytes]):
            low = splitters[r - 1] if r else None
            high = splitters[r] if r < len(splitters) else None
            keys, shared = [], []
            for s, n in longest_shared(iter(LoserTree([read_run(b) for b in blobs])), low, high):
                keys.append(suffix_key(s))
                shared.append(n)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shared, pa.int32())], ["key", "shared"])

        now, blobs = None, []
        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r != now and blobs:
                    yield done(now, blobs)
                    blobs = []
                now = r
                blobs.append(blob)
        if blobs:
            yield done(now, blobs)

    sent = suffixes.select("s").mapInArrow(runs, "range int, run binary")
    dealt = sent.repartition(min(len(splitters) + 1, 20_000), "range").sortWithinPartitions("range")
    return dealt.mapInArrow(merge, "key long, shared int")


# --- Spark ---------------------------------------------------------------------------


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(k, gram, context, rid, at, first, last) of every anchor; ``rid`` is a number of the row's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                raw, starts = text_bytes(part.column(1))
                owner, anchor, first, last, gram, context = anchors(raw, starts)
                ints = [pa.array((x - starts[owner]).astype(np.int32)) for x in (anchor, first, last)]
                hashes = [pa.array(x.view(np.int64)) for x in (gram, context)]
                own = pa.array(np.arange(rid, rid + len(owner)))
                rid += len(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), *hashes, own, *ints],
                    ["k", "gram", "context", "rid", "at", "first", "last"],
                )

    return texts.mapInArrow(run, "k long, gram long, context long, rid long, at int, first int, last int")


def _contexts(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Of every member the bytes from its anchor on (``right``), those before it backwards (``left``), and their keys."""
    lists = members.groupBy("k").agg(F.collect_list(F.struct("gram", "rid", "alone", "at", "first", "last")).alias("m"))
    known = bloom.build(members.select("k").distinct(), "k")
    some = texts.where(bloom.may_match(known, F.col("k"))).dropDuplicates(["k"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "gram", "rid", "alone", "at", "first", "last", "left", "right", "left_key", "right_key"]
        kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int32()] * 3 + [pa.binary()] * 2 + [pa.int64()] * 2
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in batches:
            rows = []
            for k, text, m in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw = text.as_py().encode()
                for x in m.as_py():
                    left, right = raw[x["first"] : x["at"]][::-1], raw[x["at"] : x["last"] + LENGTH]
                    keys = {"left_key": suffix_key(left), "right_key": suffix_key(right)}
                    rows.append({"k": k.as_py(), **x, "left": left, "right": right, **keys})
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    joined = some.join(lists, "k").select("k", "text", "m")
    return joined.mapInArrow(
        run,
        "k long, gram long, rid long, alone boolean, at int, first int, last int, left binary, right binary, "
        "left_key long, right_key long",
    )


def _open_windows(contexts: DataFrame, open_: DataFrame) -> DataFrame:
    """(window, place, k, first, alone) of the windows that begin from ``most`` down to ``least`` bytes before the anchor.

    ``window`` is the hash of its bytes, ``place`` one of the gram and of where in it the window begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, gram, alone, at, first, least, most = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            out = []
            for i, (left, right) in enumerate(zip(batch.column(7), batch.column(8), strict=True)):
                raw = np.frombuffer(left.as_py()[::-1] + right.as_py(), np.uint8)
                before = np.arange(most[i], least[i] - 1, -1)
                begins = at[i] - first[i] - before
                place = mix(np.uint64(gram[i].view(np.uint64)) ^ mix(before.astype(np.uint64) + np.uint64(1)))
                window = span_hashes(raw, begins, begins + LENGTH, lower=False)
                out.append((window, place, np.full(len(before), k[i]), begins + first[i], np.full(len(before), alone[i])))
                if len(out) == 500 or i == batch.num_rows - 1:
                    w, p, kk, b, a = (np.concatenate(x) for x in zip(*out, strict=True))
                    columns = [w.view(np.int64), p.view(np.int64), kk, b.astype(np.int32), a]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["window", "place", "k", "first", "alone"])
                    out = []

    known = bloom.build(open_.select(F.xxhash64("rid").alias("h")), "h")
    rows = contexts.where(bloom.may_match(known, F.xxhash64("rid"))).join(open_, "rid")
    rows = rows.select("k", "gram", "alone", "at", "first", "least", "most", "left", "right")
    return rows.mapInArrow(run, "window long, place long, k long, first int, alone boolean")


def _repeated(windows: DataFrame) -> DataFrame:
    """(k, low, high) of the ``alone`` windows that some other row equals; of each batch only the last row is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, equal = None, False  # the last row, and whether it equals the one before it

        def spans(rows, chosen):
            chosen = chosen & rows[4]
            low = rows[3][chosen]
            return pa.RecordBatch.from_arrays([pa.array(rows[2][chosen]), pa.array(low), pa.array(low + np.int32(LENGTH))], ["k", "low", "high"])

        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            same = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
            chosen = np.concatenate([[equal], same]) | np.concatenate([same, [False]])
            yield spans([x[:-1] for x in rows], chosen[:-1])
            held, equal = [x[-1:] for x in rows], bool(chosen[-1])
        if held is not None:
            yield spans(held, np.array([equal]))

    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = windows.repartition(parts, "window", "place").sortWithinPartitions("window", "place")
    return dealt.mapInArrow(run, "k long, low int, high int")


def repeated_spans(texts: DataFrame, space: Workspace) -> DataFrame:
    """(k, low, high): overlapping spans of bytes to remove, for rows (k, text) of at least ``LENGTH`` bytes."""
    rows = space.stage(_anchor_rows(texts), "anchors")
    twice = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    rows = rows.where(bloom.may_match(bloom.build(twice, "gram", 27), F.col("gram")))
    # One row per distinct context, with one place where it occurs; grams let through by chance have one context, once.
    distinct = rows.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("rid"))
    distinct = space.stage(distinct, "contexts")
    settled = distinct.where("n > 1").select("gram", "context")
    whole = rows.join(settled, ["gram", "context"], "left_semi")
    whole = space.stage(whole.select("k", F.col("first").alias("low"), (F.col("last") + LENGTH).alias("high")), "whole")

    several = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1").select("gram")
    # The contexts of a common gram are dealt to several tasks.
    several = several.select("gram", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    salted = distinct.withColumn("salt", F.pmod(F.col("context"), F.lit(SALTS)))
    chosen = space.stage(salted.join(several, ["gram", "salt"], "left_semi").select("rid", (F.col("n") == 1).alias("alone")), "chosen")
    known = bloom.build(chosen.select(F.xxhash64("rid").alias("h")), "h")
    members = rows.drop("context").where(bloom.may_match(known, F.xxhash64("rid"))).join(chosen, "rid")
    members = space.stage(members, "members")
    space.drop("anchors")
    space.drop("contexts")

    contexts = space.stage(_contexts(texts, members), "suffixes")
    bounds = [
        space.stage(sorted_bounds(contexts, side).select(F.col("key").alias(f"{side}_key"), F.col("shared").alias(f"{side}_shared")), side)
        for side in ("right", "left")
    ]
    small = contexts.select("rid", "at", "first", "last", "left_key", "right_key")
    bound = small.join(bounds[0], "right_key").join(bounds[1], "left_key")
    # A window that begins d bytes before the anchor needs d shared bytes before it and LENGTH - d from it on.
    least = F.greatest(F.col("at") - F.col("last"), LENGTH - F.col("right_shared")).alias("least")
    most = F.least(F.col("at") - F.col("first"), F.col("left_shared")).alias("most")
    open_ = space.stage(bound.select("rid", least, most).where("least <= most"), "open")
    single = space.stage(_repeated(_open_windows(contexts, open_)), "single")
    return whole.unionAll(single)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, spans (the maximal removed runs, as byte offsets in order) and kept (the bytes that stay)."""
    space = Workspace(docs.sparkSession, "suffixes")
    texts = docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("k"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    long = texts.where(F.octet_length("text") >= LENGTH).select("k", "text")
    spans = repeated_spans(long, space)
    lists = spans.groupBy("k").agg(F.collect_set(F.struct("low", "high")).alias("spans"))  # bounded by one text
    lists = space.stage(lists, "spans")
    for name in ("chosen", "members", "suffixes", "left", "right", "open", "whole", "single"):
        space.drop(name)
    known = bloom.build(lists.select("k"), "k")
    touched = bloom.may_match(known, F.col("k"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                runs, kept = [], []
                for text, spans in zip(part.column(1), part.column(2), strict=True):
                    raw, own, stay, at = text.as_py().encode(), [], [], 0
                    for low, high in sorted((x["low"], x["high"]) for x in spans.as_py() or []):
                        if not own or low > at:
                            stay.append(raw[at:low])
                            own.append({"low": low})
                        at = own[-1]["high"] = max(at, high)
                    runs.append(own)
                    kept.append(b"".join([*stay, raw[at:]]))
                columns = [part.column(0), pa.array(runs, span), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", "kept"])

    schema = "doc_id long, spans array<struct<low int, high int>>, kept binary"
    changed = texts.where(touched).join(lists, "k", "left").select("doc_id", "text", "spans").mapInArrow(cut, schema)
    none = F.array().cast("array<struct<low int, high int>>")
    same = texts.where(~touched).select("doc_id", none.alias("spans"), F.col("text").cast("binary").alias("kept"))
    return changed.unionByName(same)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that stay), has_repeats,
    spans, and kept_text (the bytes that stay; U+FFFD for what is left of a character that was cut)."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return without_repeats(docs, doc_id, text).select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("has_repeats"),
        "spans",
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )
