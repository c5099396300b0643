"""The filter audit against plain loops over documents, orders and steps."""

import re
from collections import Counter
from itertools import permutations

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from adloom.llm import filter_audit, queries

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def fails(text: str, repeated: bool) -> str:
    words = re.findall("[^\x20\x09-\x0d]+", text)
    out = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
    return out + "E" * repeated


def plain(docs, labels) -> set[tuple]:
    rows = []
    for key, text, lang in docs:
        repeated = any(k is not None and key is not None and k < key and (t or "") == (text or "") for k, t, _ in docs)
        good = any(k == key and q == 1 for k, q, _ in labels if k is not None)
        toxic = any(k == key and x == 1 for k, _, x in labels if k is not None)
        rows.append((lang or "", fails(text or "", repeated), good, toxic))
    out = []
    for part in {r[0] for r in rows}:
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            every = left
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                failing = [r for r in every if letter in r[1]]
                shapley[letter] += len(gone)
                out.append((
                    part, "".join(order), step, len(left), len(gone), len(failing) - len(gone),
                    sum(r[1] == letter for r in every), sum(r[2] for r in gone), sum(r[3] for r in gone), letter,
                ))
        out = [(*r[:9], shapley[r[9]]) if r[0] == part and len(r) == 10 and isinstance(r[9], str) else r for r in out]
    return set(out)


def run(spark, docs, labels):
    found = filter_audit.audit(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    out = [tuple(r[n] for n in names) for r in found]
    assert len(out) == len(set(out))
    return set(out)


LONG = " ".join(f"w{i}" for i in range(250))
ODD = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG + " $", "en"), (4, None, None), (5, "", ""), (6, " \t\n", None),
    (None, LONG, "en"), (None, LONG, "de"), (7, "a " * 300, "de"), (8, "A B C", "de"), (8, "A B C", "de"), (8, "other", "de"),
    (9, "A B C", "de"), (10, "é#" * 50, "fr"), (11, "a\x85b c\xa0d", "fr"), (12, ("x" * 20000 + " ") * 5, "fr"), (0, LONG + " $", "pt"),
]
MARKS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), (7, 0, 1), (99, 1, 1), (9, 1, 1)]


def test_odd_documents(spark):
    assert run(spark, ODD, MARKS) == plain(ODD, MARKS)


def test_no_documents_or_labels(spark):
    assert run(spark, [], MARKS) == set()
    assert run(spark, ODD[:3], []) == plain(ODD[:3], [])


def test_a_text_on_a_third_of_all_rows(spark):
    docs = [(i, "hot text" if i % 3 == 0 else f"text {i % 400}", "en" if i % 2 else "de") for i in range(900)]
    assert run(spark, docs, MARKS) == plain(docs, MARKS)


def test_sketch_never_clears_a_repeat_and_clears_most_others(spark):
    rows = spark.range(20_000).select("id", F.lit("").alias("part"), F.lit(0).alias("mask"), (F.col("id") % 15_000).alias("t"))
    rows = rows.select("id", "part", "mask", *filter_audit._hashes("t"))
    blocks = 20_000 * filter_audit.PER_TEXT // filter_audit.BLOCK + 1
    found = filter_audit.possible_repeats(rows, filter_audit.counting_bloom(rows, blocks), blocks)
    repeats = F.col("id") % 15_000 < 5_000
    assert found.where(repeats & ~F.col("possible")).count() == 0
    assert found.where(~repeats & F.col("possible")).count() < 0.02 * 10_000


def test_only_possible_repeats_are_shuffled_and_no_python_runs(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    counts = filter_audit.mask_counts(docs, labels)
    plan = counts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["op11_bloom_audit"])
def test_query_agrees_with_its_sql(spark, data, name):
    assert difference(queries.QUERIES[name](spark, data), duck(data), queries.ORACLES[name]) is None
