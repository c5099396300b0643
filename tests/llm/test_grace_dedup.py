"""Exact dedup against a plain grouping, down to tables that hold two texts."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adloom.llm import grace_dedup, queries
from adloom.llm.grace_dedup import Settings, Table
from compare import difference, duck

TINY = Settings(table_bytes=200, table_rows=12, few=4, most_partitions=3)


def plain(rows):
    """Groups by a dictionary: (doc_id, keep_id, group_size, kept, sha), sorted."""
    found = defaultdict(list)
    for i, (key, text) in enumerate(rows):
        found[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append((key is None, key or 0, i, key))
    out = []
    for text, members in found.items():
        keep = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(key, keep[3], len(members), i == keep[2], sha) for _, _, i, key in members]
    return sorted(out, key=repr)


def run(spark, rows, s, parts=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, F.col("text").isNull(), "doc_id")
    return sorted([tuple(r) for r in grace_dedup.groups(docs, s=s).collect()], key=repr)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "\t\n "), (None, "a  b"), (5, "a b"), (5, "a b"), (6, "a\x0bb"), (7, "a b"),
    (8, "x" * 5000), (9, "x" * 5000), (10, "x" * 4999 + "y"), (None, None), (None, "only"), (None, "only"), (11, "A b"),
]


@pytest.mark.parametrize("s", [Settings(), TINY])
def test_groups_of_odd_texts(spark, s):
    assert run(spark, ODD, s) == plain(ODD)


def test_a_text_on_a_third_of_all_rows_and_small_tables(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 97} " + "z" * (i % 50)) for i in range(900)]
    assert run(spark, rows, TINY, parts=40) == plain(rows)


def test_levels_are_added_until_buckets_fit(spark, monkeypatch):
    seen = []
    level = grace_dedup._level
    monkeypatch.setattr(grace_dedup, "_level", lambda todo, k, *a: (seen.append(k), level(todo, k, *a))[1])
    rows = [(i, f"{i % 20}" * 30) for i in range(240)]
    assert run(spark, rows, TINY) == plain(rows)
    assert len(seen) > 1


def test_equal_hashes_do_not_make_equal_texts():
    table = Table()
    assert [table.place(7, c) for c in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1]
    assert [table.place(-i, b"%d" % i) for i in range(2000)] == list(range(3, 2003))
    assert table.place(-5, b"5") == 8


def test_empty_table(spark):
    assert run(spark, [], Settings()) == []


def test_drop_copies_keeps_all_columns(spark):
    rows = [(2, "a b", 1, "p"), (1, "a  b", 2, "q"), (1, "a\tb", 2, "q"), (None, None, 3, "r"), (3, "c", 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int, text_sha256 string")
    stay = grace_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    found = sorted([tuple(r) for r in stay.collect()], key=repr)
    assert len(found) == 3 and found[0][0] == 1 and found[0][2:] == (2, "q")
    assert found[1:] == [(3, "c", 4, None), (None, None, 3, "r")]


def test_documents_of_the_tables(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = grace_dedup.groups(docs, s=Settings(table_bytes=100_000, few=3))
    assert sorted([tuple(r) for r in found.collect()], key=repr) == plain(rows)


def test_query_agrees_with_its_sql(spark, data):
    assert difference(queries.QUERIES["op13_grace_dedup"](spark, data), duck(data), queries.ORACLES["op13_grace_dedup"]) is None
