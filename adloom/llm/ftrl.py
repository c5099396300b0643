"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are its distinct words, word pairs and pairs with one
word between, hashed to 2^bits coordinates. FTRL-proximal keeps a learning rate
per coordinate, and its L1 term leaves most weights at exactly zero, so the
model that goes to the executors is a short sorted list of (coordinate, weight).

It is fitted on the driver from at most ``rows`` labelled documents, chosen by
the hash of their id; every document is scored whole. Spark counts the sample's
coordinates first, and only those that can get a weight reach the driver.

Defined results: a null or empty text has no features and gets the intercept's
score. Null labels and null ids teach nothing. Repeated rows are scored alike.
Extra columns are carried through; where one has the name of the scores, theirs
gets an underscore before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adloom.llm.sampling import labelled
from adloom.llm.words import NOT_ALNUM, mix, slices, word_hashes
from adloom.llm.workspace import Workspace, spare_name

MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text scored at once: words and places of a byte take over thirty.
SCORED = 1 << 20


@dataclass(frozen=True)
class Settings:
    bits: int = 22
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.5
    passes: int = 3
    rows: int = 12000
    threshold: float = 0.3

    def penalty(self, rows: int) -> float:
        """The L1 term for a sample of this size: sums of gradients grow with its root."""
        return self.l1 * min(1.0, float(np.sqrt(rows / self.rows)))


def coordinates(words: np.ndarray, bits: int) -> np.ndarray:
    """All coordinates of a run of words: words, pairs, and pairs with one word between."""
    shift = np.uint64(64 - bits)
    with_next = mix(words[:-1] * MULTIPLIER + words[1:] + np.uint64(1))
    skipping = mix(words[:-2] * MULTIPLIER + words[2:] + np.uint64(2))
    return (np.concatenate([words, with_next, skipping]) >> shift).astype(np.int64)


def texts_coordinates(texts: pa.Array, bits: int) -> Iterator[np.ndarray]:
    words, at = word_hashes(texts, NOT_ALNUM)
    for i in range(len(texts)):
        yield coordinates(words[at[i] : at[i + 1]], bits)


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by coordinate."""

    bits: int
    intercept: float
    where: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        words, at = word_hashes(texts, NOT_ALNUM)
        dense = self._dense()
        out = np.empty(len(texts))
        for i in range(len(texts)):
            found = coordinates(words[at[i] : at[i + 1]], self.bits)
            found = found[dense[found] != 0]
            out[i] = self.intercept + dense[np.unique(found)].sum()
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))

    def _dense(self) -> np.ndarray:
        kept = self.__dict__.get("_table")
        if kept is None:
            kept = np.zeros(1 << self.bits, np.float32)
            kept[self.where] = self.weights
            object.__setattr__(self, "_table", kept)
        return kept

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}


def fit(samples: list[np.ndarray], labels: np.ndarray, known: np.ndarray, s: Settings) -> Model:
    """FTRL-proximal, one document at a time. Samples hold places in ``known``, the sorted coordinates.

    The place after all of them is the intercept, which has no L1 term.
    """
    l1 = s.penalty(len(samples))
    size = len(known)
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        pull = np.where(at == size, 0.0, l1)
        w = -(zs - np.sign(zs) * pull) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        return np.where(np.abs(zs) <= pull, 0.0, w)

    for step in range(s.passes):
        for i in np.random.default_rng(step).permutation(len(samples)):
            at = np.append(samples[i], size)
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[i]
            squares = n[at]
            sigma = (np.sqrt(squares + g * g) - np.sqrt(squares)) / s.alpha
            z[at] += g - sigma * w
            n[at] = squares + g * g
    final = weight(np.arange(size + 1))
    where = np.flatnonzero(final[:size])
    return Model(s.bits, float(final[size]), known[where].astype(np.int32), final[where].astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, s: Settings = Settings()) -> Model:
    """Fit on documents that ``labels`` (doc_id, label) knows and ``learn_from``, a condition on doc_id, admits."""
    space = Workspace(docs.sparkSession, "ftrl")
    chosen = labelled(docs, labels, label, learn_from, s.rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [np.unique(x).astype(np.int32) for x in texts_coordinates(part.column(1), s.bits)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                    ["doc_id", "y", "at"],
                )

    samples = space.stage(chosen.mapInArrow(featurise, "doc_id long, y int, at array<int>"), "samples")
    # A gradient is less than 1, so a coordinate met too rarely to add up to the L1 term keeps a weight of zero.
    counts = samples.select(F.explode("at").alias("at")).groupBy("at").count()
    often = counts.where(F.col("count") * s.passes > s.penalty(samples.count())).select("at")
    known = np.sort(often.toArrow()["at"].to_numpy())  # 2^bits at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            at = np.searchsorted(known, flat).astype(np.int32)
            kept = known[np.minimum(at, len(known) - 1)] == flat if len(known) else np.zeros(len(flat), bool)
            ends = np.concatenate([[0], np.cumsum(kept)])[ends].astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[kept]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], batch.schema.names)

    learned = samples.mapInArrow(place, samples.schema).toArrow()
    order = np.argsort(learned["doc_id"].to_numpy())
    marks = learned["y"].to_numpy().astype(float)[order]
    # Views of the lists' chunks; nothing is copied.
    views = [
        values[a:b]
        for chunk in learned["at"].chunks
        for values, ends in [(chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy())]
        for a, b in zip(ends[:-1], ends[1:])
    ]
    return fit([views[i] for i in order], marks, known, s)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a last column of scores."""

    @F.pandas_udf("double")
    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], ["text"])
            found = [model.scores(x.column(0)) for x in slices(batch, "text", SCORED)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(spare_name(docs, column), of_text("text"))
