"""Words of many texts at once, as 64-bit hashes, with numpy.

The texts of an Arrow batch lie one after the other in one buffer of UTF-8
bytes. A prefix sum of byte * P^i gives every word's polynomial hash by one
subtraction, so no Python code runs per word. Work is done in pieces of about
``PIECE`` bytes that end at a separator, which bounds memory for texts of any
length.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)

#: Space and the ASCII control characters 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Everything in ASCII that is neither letter nor digit; bytes of other characters belong to words.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((up, _P), (down, _P_INVERSE)):
        out[0] = 1
        done = 1
        while done < n:  # doubling: P^(i+done) = P^i * P^done
            step = np.uint64(pow(base, done, 1 << 64))
            take = min(done, n - done)
            out[done : done + take] = out[:take] * step
            done += take
    return up, down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i below n or more."""
    return _powers(max(1 << 20, 1 << (n - 1).bit_length()))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one uint8 array, and where each begins and the last ends; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.fill_null("").cast(pa.large_string()).cast(kind)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


def word_spans(raw: np.ndarray, starts: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; texts' borders are borders of words."""
    inside = ~separators[raw]
    before = np.empty(len(raw) + 1, bool)
    before[0], before[1:] = False, inside
    first = inside & ~before[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    borders = starts[1:-1]
    borders = borders[(borders > 0) & (borders < len(raw))]
    first[borders] |= inside[borders]
    last[borders - 1] |= inside[borders - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hash of raw[b:e] for every ascending pair (b, e) of ``begins`` and ``ends``."""
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        low = begins[at]
        to = max(at + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        piece = raw[low : ends[to - 1]]
        up, down = powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(((_LOWER[piece] if lower else piece).astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        b, e = begins[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
        at = to
    return out


def word_hashes(
    column: pa.Array | pa.ChunkedArray, separators: np.ndarray = WHITE, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and where each text's words begin (one more entry at the end)."""
    raw, starts = text_bytes(column)
    begins, ends = word_spans(raw, starts, separators)
    return span_hashes(raw, begins, ends, lower), np.searchsorted(begins, starts)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter, non-empty sequence counts as one run."""
    if not len(words):
        return words
    k = min(size, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ words[i : len(words) - k + 1 + i]) * np.uint64(_P) + np.uint64(i + k * 0x1000)
        out ^= out >> np.uint64(29)
    return mix(out)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Cut a batch so that the texts of a piece have about ``most`` bytes at most, or it is one row."""
    at = batch.schema.get_field_index(column)
    texts = batch.column(at)
    sizes = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < batch.num_rows:
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(low, high - low)
        low = high
