"""Spelling variants by finite-state composition: vocabulary, one edit, vocabulary.

1. Words and their counts: every task counts the runs of letters of its texts,
   and Spark adds the counts up. Runs of ASCII capitals and small letters are
   one word; words have a least length and a least count.
2. Two words one edit apart share a first or a last part: with p = half of the
   shorter length, an edit behind the first p letters leaves those p equal, and
   any other leaves the rest equal. So the words are dealt by the state that the
   acceptor of the vocabulary is in after p letters, read forwards and read
   backwards, once for each shorter length.
3. In each such partition a minimised acceptor of the shorter words is composed
   with the transducer of one edit and with the minimised acceptor of all its
   words, from that initial state on; the accepted pairs are enumerated. Pairs
   that share their first part are left to the forward partition, so every pair
   is found once.
4. A partition of too many words is replaced by the partitions of the states one
   letter on, and, for an edit at that letter, by words that agree in everything
   else; again until all are small.
5. A word's form is its near word of the largest count, if that is many times
   its own; following forms leads to the root. Counts grow along the way, so
   there are few steps, taken by doubling.

Defined results: null and empty texts have no words; a null id reads as empty
where ids matter; repeated rows count again; texts and runs of any length are
read whole; ties between near words go to the smaller in code-point order. An
empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adloom.llm.workspace import Workspace

LETTERS = "A-Za-zÀ-ÿ"
TO_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
#: Code points of a text that are searched at once, and distinct words that a task holds.
PIECE, HELD = 1 << 20, 500_000


@dataclass(frozen=True)
class Settings:
    least_length: int = 6
    least_count: int = 5
    #: A form has at least so many times the word's count.
    ratio: int = 5
    #: Runs whose checksum this divides lose one letter; 0 for none.
    drop_one_in: int = 0
    #: Words of one partition of the composition.
    most_words: int = 20_000


def _runs(text: str, least: int) -> Iterator[list[str]]:
    """The maximal runs of at least ``least`` letters, in pieces that end between runs."""
    run, gap = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
    at = 0
    while at < len(text):
        end = gap.search(text, at + PIECE)
        end = end.start() if end else len(text)
        yield run.findall(text, at, end)
        at = end


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings()) -> DataFrame:
    """(word, n) of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def emptied() -> Iterator[pa.RecordBatch]:
            words = list(found)
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([found[w] for w in part], pa.int64())], ["word", "n"])
            found.clear()

        for batch in batches:
            for key, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                of_text: Counter = Counter()
                for runs in _runs(cell.as_py() or "", s.least_length):
                    of_text.update(runs)
                for run, n in of_text.items():
                    word = run.translate(TO_LOWER)
                    if s.drop_one_in:
                        h = zlib.crc32(f"{key}:{word}".encode())
                        if h % s.drop_one_in == 0:
                            word = word[: h % len(word)] + word[h % len(word) + 1 :]
                            if len(word) < s.least_length:
                                continue
                    found[word] += n
                if len(found) >= HELD:
                    yield from emptied()
        yield from emptied()

    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("t"))
    partial = rows.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= s.least_count)


class Acceptors:
    """Minimised acyclic acceptors in one register: states that accept the same words are one state."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self.sizes: list[int] = []

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.arcs)
            self.final.append(final)
            self.arcs.append(arcs)
            self.sizes.append(final + sum(self.sizes[to] for to in arcs.values()))
        return state

    def build(self, words: Iterable[str]) -> int:
        """The initial state of the acceptor of ``words``, sorted and distinct."""
        path: list[list] = [[False, {}]]  # of the word before: final, arcs
        last = ""

        def fold(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1][last[len(path) - 1]] = self._state(final, arcs)

        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            fold(same)
            path.extend([False, {}] for _ in range(len(word) - same))
            path[-1][0] = True
            last = word
        fold(0)
        return self._state(*path[0])

    def common(self, a: int, b: int, skip: str = "") -> list[str]:
        """The words that both states accept, but none that begins with the letter ``skip``."""
        found, todo = [], [(a, b, "")]
        while todo:
            a, b, word = todo.pop()
            if self.final[a] and self.final[b]:
                found.append(word)
            fewer, more = (self.arcs[a], self.arcs[b]) if len(self.arcs[a]) <= len(self.arcs[b]) else (self.arcs[b], self.arcs[a])
            for letter in fewer:
                if letter in more and (word or letter != skip):
                    todo.append((self.arcs[a][letter], self.arcs[b][letter], word + letter))
        return found


def compose(short: list[str], all_words: list[str], deep: bool = True) -> Iterator[tuple[str, str]]:
    """Pairs (a, b) one edit apart, a of ``short`` and b of ``all_words``, which holds them and words one letter longer.

    Both lists are sorted. An inserted letter is taken to stand behind equal
    ones, so that each pair has one path. ``deep=False``: only an edit at the
    first letter.
    """
    net = Acceptors()
    first = net.build(short), net.build(all_words)
    met: dict[tuple, list[str]] = {}

    def common(a: int, b: int, skip: str = "") -> list[str]:
        key = (a, b, skip)
        if key not in met:
            met[key] = net.common(a, b, skip)
        return met[key]

    todo = [(*first, "")]
    while todo:
        a, b, before = todo.pop()
        left, right = net.arcs[a], net.arcs[b]
        for c, d in combinations(left, 2):
            for rest in common(left[c], left[d]):
                yield before + c + rest, before + d + rest
        for d in right:
            for rest in common(a, right[d], d):
                yield before + rest, before + d + rest
        if deep:
            todo.extend((left[c], right[c], before + c) for c in left if net.sizes[right[c]] > 1)


KEY = ["len", "back", "kind", "at", "key"]


def _dealt(words: DataFrame, s: Settings) -> DataFrame:
    """Every word under each initial state that it is looked at from: columns of KEY, t (the word in reading direction), n."""
    lengths = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select("word", "n", F.explode(lengths).alias("len")).where(F.col("len") >= s.least_length)
    rows = rows.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    rows = rows.withColumn("t", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")))
    rows = rows.withColumn("at", F.expr("CASE WHEN back THEN len - len DIV 2 ELSE len DIV 2 END").cast("int"))
    return rows.select("len", "back", F.lit("state").alias("kind"), "at", F.expr("left(t, at)").alias("key"), "t", "n")


def _partitions(words: DataFrame, space: Workspace, s: Settings) -> DataFrame:
    """The words by partitions of at most ``most_words``, but for partitions of one edit, which an alphabet bounds."""
    rows, done, step = space.stage(_dealt(words, s), "dealt-0"), None, 0
    while True:
        large = rows.where("kind = 'state'").groupBy(*KEY).count().where(F.col("count") > s.most_words).select(*KEY)
        large = space.stage(large, f"large-{step}")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, KEY, "left_anti")
        done = small if done is None else done.unionByName(small)
        split = rows.join(large, KEY, "left_semi")
        onward = split.where("length(t) > at").withColumn("at", F.col("at") + 1).withColumn("key", F.expr("left(t, at)"))
        without = F.expr("concat(left(t, at), substring(t, at + 2))")
        edits = split.withColumn("kind", F.lit("edit"))
        edits = edits.where("length(t) > at").withColumn("key", without).unionByName(edits.where("length(t) = len").withColumn("key", F.col("t")))
        step += 1
        rows = space.stage(onward.unionByName(edits).select(*rows.columns), f"dealt-{step}")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by KEY and t to directed pairs."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held))
        held.clear()
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n", "near", "near_n"])

    def enumerate_pairs(name: tuple, counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
        length, back, kind, at, _ = name
        # The prefix was read before the initial state, by all words of the partition.
        words = [t[at:] for t in counts]
        short = [t[at:] for t in counts if len(t) == length]
        if not short or len(words) < 2:
            return
        start = next(iter(counts))[:at]
        for a, b in compose(short, words, deep=kind == "state"):
            a, b = start + a, start + b
            n, m = counts[a], counts[b]
            if back:
                a, b = a[::-1], b[::-1]
                if a[: length // 2] == b[: length // 2]:
                    continue
            held.append((a, n, b, m))
            held.append((b, m, a, n))
            if len(held) >= 50_000:
                yield batch()

    name, counts = None, {}
    for arrow in batches:
        for *key, t, n in zip(*[c.to_pylist() for c in arrow.columns]):
            if tuple(key) != name:
                if name is not None:
                    yield from enumerate_pairs(name, counts)
                name, counts = tuple(key), {}
            counts[t] = n
    if name is not None:
        yield from enumerate_pairs(name, counts)
    if held:
        yield batch()


def near_pairs(words: DataFrame, space: Workspace, s: Settings = Settings()) -> DataFrame:
    """(word, n, near, near_n): every pair of words (word, n) one edit apart, in both directions."""
    dealt = _partitions(words, space, s)
    dealt = dealt.repartition(*KEY).sortWithinPartitions(*KEY, "t")
    return dealt.mapInArrow(_pairs, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame, space: Workspace) -> DataFrame:
    """(word, root) of every word (word, form) that has a form; each round doubles the steps taken."""
    now, step = space.stage(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        joined = now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        step += 1
        now = space.stage(joined, f"roots-{step}")
        if now.where("moved").isEmpty():
            space.keep_only("words", "met", f"roots-{step}")
            return now.select("word", "root")
        now = now.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    space = Workspace(docs.sparkSession, "spelling")
    words = space.stage(count_words(docs, doc_id, text, s), "words")
    pairs = near_pairs(words, space, s)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    met = pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.minus") >= s.ratio * F.col("n")
    met = met.select("word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n"))
    met = space.stage(met, "met")
    roots = _roots(met.where("form IS NOT NULL"), space)
    out = words.join(met, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
