"""Spelling variants against a brute force over all letters of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from adloom.llm import queries, spelling
from adloom.llm.spelling import Acceptors, Settings, compose
from adloom.llm.workspace import Workspace


def one_edit(word: str, alphabet: set[str]) -> set[str]:
    parts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in parts if b}
    out |= {a + c + b[1:] for a, b in parts if b for c in alphabet}
    out |= {a + c + b for a, b in parts for c in alphabet}
    return out - {word}


def plain_pairs(counts: dict[str, int]) -> set[tuple]:
    alphabet = {c for w in counts for c in w}
    return {(w, n, v, counts[v]) for w, n in counts.items() for v in one_edit(w, alphabet) if v in counts}


def plain(rows, s: Settings) -> dict:
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if s.drop_one_in and h % s.drop_one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= s.least_length:
                found[word] += 1
    counts = {w: n for w, n in found.items() if n >= s.least_count}
    near: dict[str, list] = {w: [] for w in counts}
    for w, _, v, m in plain_pairs(counts):
        near[w].append((-m, v))
    form = {w: min(v)[1] for w, v in near.items() if v and -min(v)[0] >= s.ratio * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def run(spark, rows, s):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = spelling.variants(docs, s=s).collect()
    out = {r.word: tuple(r) for r in found}
    assert len(out) == len(found)
    return out


def vocabulary(n, letters="abcé", longest=11, seed=0):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(6, longest))): rng.randint(5, 900) for _ in range(n)}


def test_acceptors_are_minimal():
    net = Acceptors()
    start = net.build(["abc", "abd", "xbc", "xbd"])
    assert net.arcs[start]["a"] == net.arcs[start]["x"] and net.sizes[start] == 4 and len(net.arcs) == 4
    assert sorted(net.common(start, net.build(["abd", "xbc", "xbe"]))) == ["abd", "xbc"]


def test_composition_finds_each_pair_once():
    words = sorted({w[: random.Random(w).randint(2, 4)] for w in vocabulary(60, "ab", 8)} | {"aab", "ab", "aaab", "aabb"})
    for length in {len(w) for w in words}:
        short = [w for w in words if len(w) == length]
        both = [w for w in words if len(w) in (length, length + 1)]
        found = list(compose(short, both))
        assert len(found) == len(set(found))
        want = {(w, v) for w in short for v in one_edit(w, set("ab")) & set(both) if len(v) > length or w < v}
        assert {(a, b) if len(a) < len(b) else tuple(sorted((a, b))) for a, b in found} == want


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_pairs_whatever_the_partitions(spark, most):
    counts = vocabulary(700) | vocabulary(150, "ab", 8, 1) | {"x" * 300: 9, "x" * 301: 8, "x" * 299 + "y": 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = spelling.near_pairs(words, Workspace(spark, "test-spelling"), Settings(most_words=most)).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == plain_pairs(counts)


ODD = [
    (1, None), (2, ""), (3, "123 -- ×÷ short"), (None, "Letters letters LETTERS"), (None, "Letters letters LETTERS"),
    (4, "letter " * 40 + "lettre " * 6 + "lettor " * 5), (5, "Étésol étésol " * 6), (6, "x" * 5000 + " " + "x" * 5000),
    (7, ("a" * 4999 + " ") * 6 + ("a" * 5000 + " ") * 40), (8, "straßen-strassen " * 9), (8, "nähert nahert " * 7),
]


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 50)
    for s in (Settings(), Settings(drop_one_in=3)):
        assert run(spark, ODD, s) == plain(ODD, s)


def test_empty_table(spark):
    assert run(spark, [], Settings()) == {}


def test_roots_follow_forms(spark):
    rows = [(1, "letter " * 700 + "lettex " * 130 + "lettyx " * 25 + "leztyx " * 5)]
    found = run(spark, rows, Settings())
    assert found == plain(rows, Settings())
    assert found["leztyx"][1:3] == ("lettyx", "letter")


def test_documents_of_the_tables(spark, data, texts):
    s = Settings(drop_one_in=199)
    found = queries.QUERIES["op12_spelling_composition"](spark, data).collect()
    assert {r.word: (r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == plain(texts.items(), s)
