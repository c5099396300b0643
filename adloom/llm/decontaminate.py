"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question whose numbers
or names were swapped keeps its template. Windows of five template tokens of
benchmark items and documents meet in a hash join, and the placeholders' values
are checked for consistency: within a document every value of an item's slots
must stand for one value of the document (the one it most often meets); windows
that disagree don't count. A document leaks an item when at least 0.8 of the
item's distinct windows are found.

The first word of a sentence has a capital, name or not, so it is read both
ways, as an ordinary word and as a name slot, in items and documents; a window
of an item is found when any of its readings is.

A name shows by its one capital, which text in all capitals or none lacks. So
lower-cased texts are matched as well, where names are ordinary words (numbers
and units stay slots); an item leaks by its templates or by its folded windows.

Only windows that a fixed-size Bloom filter of benchmark windows lets through
are shuffled, so the benchmark may be of any size.

Defined results: null and empty texts leak nothing; an item of fewer than five
tokens is one window of its length; items without any ordinary word (null and
empty ones too) are never found. Rows are told apart by id and text, so
repeated ids and null ids are judged by their own text; repeated rows give one
result. Extra columns are ignored by ``leaks`` and carried through by
``drop_leaks``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from adloom.llm import bloom
from adloom.llm.words import NOT_ALNUM, mix, slices, span_hashes, text_bytes, word_hashes, word_spans
from adloom.llm.workspace import Workspace, spare_name

#: Bytes of texts worked on at once, or one text.
PIECE = 1 << 20
WINDOW = 5
SHARE = 0.8

#: Words that are a unit when they follow a number (fixed values).
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons tonne tonnes oz lb lbs pound pounds ml cl l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years k c f degree degrees v w kw mw wh kwh j kj hz khz mhz ghz b kb mb gb tb usd eur gbp dollar dollars euro euros cent "
    "cents percent pct kmh mph"
).split()
UNIT_HASHES = np.sort(word_hashes(pa.array([" ".join(UNITS)]))[0])

LITERAL, NUMBER, NAME, UNIT = range(4)
SLOT_HASHES = mix(np.arange(4, dtype=np.uint64) + np.uint64(0xA11CE))

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:\n"]] = True


def _before(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


class Templates(NamedTuple):
    """Tokens of many texts: each has a hash and a slot value (0: an ordinary word); ``at``: where each text's tokens begin.

    A token that opens a sentence and may be a name has the name's value in ``names`` (0: none), which takes in the
    names right behind it; ``after`` is the token that then comes next.
    """

    tokens: np.ndarray
    values: np.ndarray
    at: np.ndarray
    names: np.ndarray
    after: np.ndarray


def _slots(kind: np.ndarray, hashes: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word begins a token (numbers or names side by side are one, unless ``apart``), and the tokens' values."""
    head = np.ones(len(kind), bool)
    head[1:] = ~((kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME)) & ~apart[1:])
    heads = np.flatnonzero(head)
    within = np.arange(len(kind)) - np.repeat(heads, np.diff(np.append(heads, len(kind))))
    values = np.add.reduceat(mix(hashes + within.astype(np.uint64)), heads)
    values[values == 0] = 1
    return head, values


def templates(texts: pa.Array) -> Templates:
    raw, starts = text_bytes(texts)
    begins, ends = word_spans(raw, starts, NOT_ALNUM)
    at = np.searchsorted(begins, starts)
    if not len(begins):
        none = np.zeros(0, np.uint64)
        return Templates(none, none, at, none, np.zeros(0, np.int64))
    hashes = span_hashes(raw, begins, ends)
    uppers, digits, stops = _before(_UPPER[raw]), _before(_DIGIT[raw]), _before(_STOP[raw])
    number = digits[ends] > digits[begins]
    second = raw[np.minimum(begins + 1, len(raw) - 1)]
    accented = (raw[begins] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    n_upper = uppers[ends] - uppers[begins]
    proper = np.where(accented, n_upper == 0, _UPPER[raw[begins]] & (n_upper == 1)) & (ends - begins > 1)
    opening = np.ones(len(begins), bool)  # the first word of a text or sentence may always have a capital
    opening[1:] = stops[begins[1:]] > stops[ends[:-1]]
    opening[at[:-1][at[:-1] < len(begins)]] = True
    same_text = np.ones(len(begins), bool)
    same_text[at[:-1][at[:-1] < len(begins)]] = False
    kind = np.where(number, NUMBER, np.where(proper & ~opening, NAME, LITERAL))
    follows_number = np.concatenate([[False], number[:-1]]) & same_text
    place = np.minimum(np.searchsorted(UNIT_HASHES, hashes), len(UNIT_HASHES) - 1)
    kind[(UNIT_HASHES[place] == hashes) & follows_number & (kind == LITERAL)] = UNIT
    head, values = _slots(kind, hashes, ~same_text)
    heads = np.flatnonzero(head)
    count = np.append(np.cumsum(head) - head, len(heads))  # tokens before each word
    # The other reading of an opening word: a name, one slot with the names behind it.
    doubtful = proper & opening & ~number
    named, name_values = _slots(np.where(doubtful, NAME, kind), hashes, ~same_text | doubtful)
    opener = np.flatnonzero(doubtful)
    group = np.cumsum(named)[opener] - 1
    names, after = np.zeros(len(heads), np.uint64), np.arange(1, len(heads) + 1)
    names[count[opener]] = name_values[group]
    after[count[opener]] = count[np.append(np.flatnonzero(named), len(kind))[group + 1]]
    kind = kind[heads]
    values[kind == LITERAL] = 0
    tokens = np.where(kind == LITERAL, hashes[heads], SLOT_HASHES[kind])
    return Templates(tokens, values, count[at], names, after)


_NEXT = np.uint64(0x9FB21C651E98DF25)


def folded(texts: pa.Array) -> pa.Array:
    try:
        return pc.utf8_lower(texts)
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pc.ascii_lower(texts)


#: Readings of a text: as it is, and folded.
READINGS = (lambda texts: templates(texts), lambda texts: templates(folded(texts)))


def _prefixes(tokens: np.ndarray, size: int) -> list[np.ndarray]:
    """Hashes of the first 0 to ``size`` tokens from every token on, as part of a window of ``size``."""
    out = [np.full(len(tokens) + 1, size, np.uint64)]
    for i in range(size):
        n = max(0, len(tokens) - i)
        out.append(mix(out[-1][:n] * _NEXT + tokens[i : i + n]))
    return out


def _named_paths(t: Templates, size: int, prefixes: list[np.ndarray]):
    """(begin, end, hash, choices) of all windows that read an opening word as a name; bit i of ``choices``: the i-th token is read so."""
    openers = np.flatnonzero(t.names)
    first = t.at[np.searchsorted(t.at, openers, "right") - 1]
    begin, now, hashes, choices = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    for i in range(size):
        here = openers[openers - i >= first]
        inside = now < len(t.tokens)
        begin, now, hashes, choices = begin[inside], now[inside], hashes[inside], choices[inside]
        again = np.flatnonzero(t.names[now])
        name, bit = SLOT_HASHES[NAME], np.uint8(1 << i)
        hashes = np.concatenate(
            [mix(hashes * _NEXT + t.tokens[now]), mix(hashes[again] * _NEXT + name), mix(prefixes[i][here - i] * _NEXT + name)]
        )
        choices = np.concatenate([choices, choices[again] | bit, np.full(len(here), bit)])
        begin = np.concatenate([begin, begin[again], here - i])
        now = np.concatenate([now + 1, t.after[now[again]], t.after[here]])
    return begin, now, hashes, choices


def windows(t: Templates, size: int, known=None, reading: int = 0):
    """(text, begin, end, hash, slot values) of all readings of windows of ``size`` tokens with an ordinary word.

    ``known``: a Bloom filter that the hash, as seeded for ``reading``, must pass.
    """
    prefixes = _prefixes(t.tokens, size)
    plain = prefixes[size][: max(0, len(t.tokens) - size + 1)]
    begin, end, hashes, choices = _named_paths(t, size, prefixes)
    if known is not None:
        found = np.flatnonzero(bloom.maybe(known, _seeded(plain, reading)))
        some = bloom.maybe(known, _seeded(hashes, reading))
        begin, end, hashes, choices = begin[some], end[some], hashes[some], choices[some]
    else:
        found = np.arange(len(plain))
    begin, end = np.concatenate([found, begin]), np.concatenate([found + size, end])
    hashes, choices = np.concatenate([plain[found], hashes]), np.concatenate([np.zeros(len(found), np.uint8), choices])
    text = np.searchsorted(t.at, begin, "right") - 1
    good = end <= t.at[text + 1]
    text, begin, end, hashes, choices = text[good], begin[good], end[good], hashes[good], choices[good]
    slots, now = np.zeros((len(begin), WINDOW), np.uint64), begin
    for i in range(size):
        named = (choices >> i) & 1 == 1
        slots[:, i] = np.where(named, t.names[now], t.values[now])
        now = np.where(named, t.after[now], now + 1)
    good = (slots[:, :size] == 0).any(axis=1)
    return text[good], begin[good], end[good], hashes[good], slots[good]


def item_windows(t: Templates, size: int):
    """(text, plain hash, hash, slot values) of the readings, of ``size`` tokens, of the windows that texts are made of.

    A window is named by its plain reading: ``WINDOW`` tokens, or all of a shorter text. Where names run together a
    reading may come to the end of the text with fewer tokens than the plain one.
    """
    text, begin, end, hashes, slots = windows(t, size)
    full = np.minimum(WINDOW, t.at[text + 1] - t.at[text])
    good = begin + full <= t.at[text + 1]
    if size < WINDOW:
        good &= end == t.at[text + 1]
    plain = np.zeros(len(text), np.uint64)
    literal = _before(t.values == 0)
    for n in range(size, WINDOW + 1):
        rows = np.flatnonzero(good & (full == n))
        plain[rows] = _prefixes(t.tokens, n)[n][begin[rows]]
    to = np.minimum(begin + full, len(t.tokens))
    good &= literal[to] > literal[begin]
    return text[good], plain[good], hashes[good], slots[good]


def _distinct(text: np.ndarray, *columns: np.ndarray):
    """Distinct rows of the texts' numbers, columns of hashes, and slots."""
    *hashes, slots = columns
    rows = np.unique(np.column_stack([text.astype(np.uint64), *hashes, slots]), axis=0)
    n = 1 + len(hashes)
    return rows[:, 0].astype(np.int64), *(rows[:, i] for i in range(1, n)), rows[:, n:]


def _slot_lists(slots: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(slots).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, slots.size + 1, WINDOW, dtype=np.int32)), flat)


def _seeded(hashes: np.ndarray, reading: int) -> np.ndarray:
    """Hashes that differ between readings."""
    return mix(hashes + np.uint64(reading)) if reading else hashes


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, reading, plain window, window, slots, size) of every item: each window in all its readings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                plain_texts = None
                for reading, read in enumerate(READINGS):
                    found = read(part.column(1))
                    rows = [(size, *_distinct(*item_windows(found, size))) for size in range(1, WINDOW + 1)]
                    texts = np.concatenate([where for _, where, *_ in rows])
                    plain_texts = texts if plain_texts is None else plain_texts
                    for size, where, plain, hashes, slots in rows:
                        some = np.isin(where, plain_texts)  # an item of names and numbers alone has no words when folded either
                        where, n = pa.array(where[some]), int(some.sum())
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(where),
                                pa.array(np.full(n, reading, np.int32)),
                                pa.array(plain[some].view(np.int64)),
                                pa.array(_seeded(hashes[some], reading).view(np.int64)),
                                _slot_lists(slots[some]),
                                pa.array(np.full(n, size, np.int32)),
                            ],
                            ["item_id", "reading", "plain", "window", "item_slots", "size"],
                        )

    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id IS NOT NULL")
    return rows.mapInArrow(run, "item_id long, reading int, plain long, window long, item_slots array<long>, size int").distinct()


def _agree(rows, stands: dict[int, int]) -> tuple[int, int]:
    good = {r["plain"] for r in rows if all(not a or stands[a] == b for a, b in zip(r["item_slots"], r["doc_slots"]))}
    return len(good), sum(a != b for a, b in stands.items())


def _consistent(pairs: pd.Series) -> pd.DataFrame:
    """Distinct windows whose slots agree with the prevailing value of each slot, and how many slot values differ.

    A value that also meets itself stands for itself, or for what it meets most: whichever more windows agree with.
    """
    out = []
    for rows in pairs:
        meets: dict[int, Counter] = defaultdict(Counter)
        for r in rows:
            for a, b in zip(r["item_slots"], r["doc_slots"]):
                if a:
                    meets[a][b] += 1
        most = {a: min(c, key=lambda b: (-c[b], b)) for a, c in meets.items()}
        same = {a: a if a in c else most[a] for a, c in meets.items()}
        best = _agree(rows, same)
        if same != most:
            other = _agree(rows, most)
            best = other if other[0] > best[0] else best
        out.append(best)
    return pd.DataFrame(out, columns=["found", "changed"])


def row_key(doc_id: str = "doc_id", text: str = "text"):
    return F.xxhash64(F.col(doc_id), F.col(text))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    share: float = SHARE,
) -> DataFrame:
    """One row per (document, leaked item): doc_id, item_id, n_windows, n_found, n_changed (slot values that were swapped)."""
    found = _leaks(docs, benchmark, doc_id, text, item_id, item_text, share)
    return found.select("doc_id", "item_id", "n_windows", "n_found", "n_changed")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    key = spare_name(docs, "_key")
    found = _leaks(docs, benchmark, doc_id, text, "item_id", "text", share)
    keyed = docs.withColumn(key, row_key(doc_id, text))
    return keyed.join(found.select(F.col("k").alias(key)).distinct(), key, "left_anti").drop(key)


def _leaks(docs, benchmark, doc_id, text, item_id, item_text, share) -> DataFrame:
    space = Workspace(docs.sparkSession, "decontaminate")
    items = space.stage(benchmark_windows(benchmark, item_id, item_text), "items")
    sizes = sorted((r["reading"], r["size"]) for r in items.select("reading", "size").distinct().collect())  # ten at most
    known = bloom.build(items.select("window"), "window", 24)

    def met_by(t: Templates, reading: int, size: int):
        text, _, _, hashes, slots = windows(t, size, known, reading)
        return _distinct(text, _seeded(hashes, reading), slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                read, done = None, -1
                for reading, size in sizes:  # sorted, so one reading at a time is held
                    if reading != done:
                        read = None
                        read, done = READINGS[reading](part.column(2)), reading
                    where, hashes, slots = met_by(read, reading, size)
                    take = pa.array(where)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), pa.array(hashes.view(np.int64)), _slot_lists(slots)],
                        ["k", "doc_id", "window", "doc_slots"],
                    )

    texts = docs.select(row_key(doc_id, text).alias("k"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = texts.mapInArrow(run, "k long, doc_id long, window long, doc_slots array<long>")
    totals = items.groupBy("item_id", "reading").agg(F.count_distinct("plain").alias("n_windows"))
    met = held.join(items.drop("size"), "window").distinct()
    grouped = met.groupBy("k", "doc_id", "item_id", "reading").agg(
        F.count_distinct("plain").alias("n"),
        F.collect_list(F.struct("plain", "item_slots", "doc_slots")).alias("pairs"),  # bounded by one text and one item
    )
    likely = grouped.join(totals, ["item_id", "reading"]).where(F.col("n") >= share * F.col("n_windows"))
    checked = likely.withColumn("checked", F.pandas_udf(_consistent, "found long, changed long")("pairs"))
    found = checked.where(F.col("checked.found") >= share * F.col("n_windows"))
    # Both readings may tell; the figures are those of the templates then.
    first = F.min(F.struct("reading", "n_windows", "checked")).alias("x")
    return found.groupBy("k", "doc_id", "item_id").agg(first).select(
        "k",
        "doc_id",
        "item_id",
        F.col("x.n_windows").alias("n_windows"),
        F.col("x.checked.found").alias("n_found"),
        F.col("x.checked.changed").alias("n_changed"),
    )
