"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
from counts over its bytes and words; a gated attention, learned from labels of
whole documents only, weighs the encoded passages; the weighted mean is scored.

    h = tanh(E x + e)            encoded passage
    a = softmax(w . (tanh(V h) * sigmoid(U h)))     over the passages of a document
    score = sigmoid(c . sum(a h) + d)

It is fitted on the driver from at most ``rows`` labelled documents, chosen by
the hash of their id; every document is scored whole.

Defined results: a null or empty text, or one of white space only, has no
passage and gets the share of good documents among those learned from. Null
labels and null ids teach nothing. Repeated rows are scored alike. Extra
columns are carried through; where one has the name of the scores, theirs gets
an underscore before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adloom.llm.sampling import labelled
from adloom.llm.words import WHITE, slices, span_hashes, text_bytes, word_spans
from adloom.llm.workspace import spare_name

PASSAGE = 64


@dataclass(frozen=True)
class Settings:
    rows: int = 4000
    steps: int = 400
    rate: float = 0.03
    decay: float = 1e-4
    encoded: int = 12
    attention: int = 6
    threshold: float = 0.7


def _classes() -> np.ndarray:
    """Class of every byte: 0 lower, 1 upper, 2 digit, 3 sentence mark, 4 bar or other bracket, 5 other mark, 6 beyond ASCII, 7 white."""
    kind = np.full(256, 5)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            kind[b] = 6
        elif c.islower():
            kind[b] = 0
        elif c.isupper():
            kind[b] = 1
        elif c.isdigit():
            kind[b] = 2
        elif c in ".,;:'\"-":
            kind[b] = 3
        elif c in "|<>[]{}()\\/_=~^":
            kind[b] = 4
    kind[WHITE] = 7
    return kind


CLASSES = _classes()
FEATURES = 18


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (n, FEATURES), and where each text's passages begin (one more entry)."""
    raw, starts = text_bytes(texts)
    begins, ends = word_spans(raw, starts)
    at = np.searchsorted(begins, starts)
    counts = np.diff(at)
    n_passages = -(-counts // PASSAGE)
    of_text = np.concatenate([[0], np.cumsum(n_passages)])
    if not len(begins):
        return np.zeros((0, FEATURES)), of_text
    # First word of every passage, and one past the last.
    inner = np.arange(of_text[-1]) - np.repeat(of_text[:-1], n_passages)
    first = np.repeat(at[:-1], n_passages) + inner * PASSAGE
    last = np.minimum(first + PASSAGE, np.repeat(at[1:], n_passages))
    n_words = (last - first).astype(float)
    low, high = begins[first], ends[last - 1]
    n_bytes = (high - low).astype(float)

    out = np.empty((len(first), FEATURES))
    kinds = CLASSES[raw]
    for k in range(8):
        sums = np.concatenate([[0], np.cumsum(kinds == k)])
        out[:, k] = (sums[high] - sums[low]) / n_bytes
    words = span_hashes(raw, begins, ends)
    length = (ends - begins).astype(float)

    def mean(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return (sums[last] - sums[first]) / n_words

    out[:, 8] = mean(length) / 10
    out[:, 9] = np.sqrt(np.maximum(mean(length * length) - mean(length) ** 2, 0)) / 10
    out[:, 10] = mean(np.concatenate([[False], words[1:] == words[:-1]]))
    out[:, 11] = mean(kinds[ends - 1] == 5)
    out[:, 12] = mean(kinds[begins] == 1)
    out[:, 13] = mean(length == 1)
    passage = np.repeat(np.arange(len(first)), last - first)
    order = np.lexsort((words, passage))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][fresh], minlength=len(first))
    out[:, 14] = distinct / n_words
    # Words that the document has already had in an earlier passage.
    text = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((words, text))
    again = np.zeros(len(words), bool)
    again[order[1:]] = (words[order][1:] == words[order][:-1]) & (text[order][1:] == text[order][:-1])
    out[:, 15] = mean(again)
    out[:, 16] = np.minimum(length_runs(kinds, low, high), 1)
    out[:, 17] = n_words / PASSAGE
    return out, of_text


def length_runs(kinds: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Share of bytes that are a mark after a mark, in each stretch."""
    marks = (kinds == 5) | (kinds == 4)
    sums = np.concatenate([[0, 0], np.cumsum(marks[1:] & marks[:-1])])
    return (sums[high] - sums[low]) / (high - low)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    parts: dict
    prior: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        x, at = passages(texts)
        out = np.full(len(texts), self.prior)
        some = np.flatnonzero(np.diff(at))
        if len(some):
            out[some] = _sigmoid(_forward(self.parts, (x - self.mean) / self.scale, at[some])["logit"])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _forward(p: dict, x: np.ndarray, begin: np.ndarray) -> dict:
    """begin: first passage of every bag that has any; bags follow each other."""
    h = np.tanh(x @ p["E"] + p["e"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    raw = (t * g) @ p["w"]
    counts = np.diff(np.append(begin, len(x)))
    spread = np.exp(raw - np.repeat(np.maximum.reduceat(raw, begin), counts))
    a = spread / np.repeat(np.add.reduceat(spread, begin), counts)
    bag = np.add.reduceat(a[:, None] * h, begin)
    return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "counts": counts, "logit": bag @ p["c"] + p["d"]}


def _gradients(p: dict, x: np.ndarray, begin: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(p, x, begin)
    h, t, g, a, counts = f["h"], f["t"], f["g"], f["a"], f["counts"]
    error = (_sigmoid(f["logit"]) - y) / len(y)
    wide = np.repeat(error, counts)
    along = h @ p["c"]
    d_raw = wide * a * (along - np.repeat(f["bag"] @ p["c"], counts))
    d_t, d_g = d_raw[:, None] * g * p["w"] * (1 - t * t), d_raw[:, None] * t * p["w"] * g * (1 - g)
    d_h = (wide * a)[:, None] * p["c"] + d_t @ p["V"].T + d_g @ p["U"].T
    d_in = d_h * (1 - h * h)
    return {
        "E": x.T @ d_in,
        "e": d_in.sum(0),
        "V": h.T @ d_t,
        "U": h.T @ d_g,
        "w": (t * g).T @ d_raw,
        "c": f["bag"].T @ error,
        "d": error.sum(),
    }


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, s: Settings) -> Model:
    """Adam on the whole sample; ``counts``: passages of every document, each at least one."""
    prior = float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(0)
    k, m = s.encoded, s.attention
    p = {
        "E": rng.normal(size=(FEATURES, k)) / np.sqrt(FEATURES),
        "e": np.zeros(k),
        "V": rng.normal(size=(k, m)) / np.sqrt(k),
        "U": rng.normal(size=(k, m)) / np.sqrt(k),
        "w": rng.normal(size=m) / np.sqrt(m),
        "c": rng.normal(size=k) / np.sqrt(k),
        "d": np.float64(np.log((prior + 1e-3) / (1 - prior + 1e-3))),
    }
    if not len(y):
        return Model(np.zeros(FEATURES), np.ones(FEATURES), p, prior)
    mean, scale = x.mean(0), x.std(0) + 1e-2
    x = (x - mean) / scale
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    first, second = ({n: np.zeros_like(v) for n, v in p.items()} for _ in range(2))
    for step in range(1, s.steps + 1):
        rate = s.rate * 0.5 * (1 + np.cos(np.pi * step / s.steps))
        for n, d in _gradients(p, x, begin, y).items():
            d = d + s.decay * p[n]
            first[n] = 0.9 * first[n] + 0.1 * d
            second[n] = 0.999 * second[n] + 0.001 * d * d
            p[n] = p[n] - rate * first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p, prior)


def train(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, s: Settings = Settings()) -> Model:
    """Fit on documents that ``labels`` (doc_id, label) knows and ``learn_from``, a condition on doc_id, admits."""
    chosen = labelled(docs, labels, label, learn_from, s.rows)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, at = passages(part.column(1))
                rows = [x[at[i] : at[i + 1]].ravel() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2).cast(pa.int32()), pa.array(rows, pa.list_(pa.float64()))],
                    ["doc_id", "y", "x"],
                )

    learned = chosen.mapInArrow(encode, "doc_id long, y int, x array<double>").toPandas()
    learned = learned[learned.x.map(len) > 0].sort_values("doc_id", kind="stable")
    bags = [np.asarray(b, float).reshape(-1, FEATURES) for b in learned.x]
    x = np.concatenate(bags) if bags else np.zeros((0, FEATURES))
    return fit(x, np.array([len(b) for b in bags], int), learned.y.to_numpy(float), s)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a last column of scores."""

    @F.pandas_udf("double")
    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], ["text"])
            found = [model.scores(x.column(0)) for x in slices(batch, "text", 1 << 20)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(spare_name(docs, column), of_text("text"))
