"""How quality filters interact: what each removes in every order, from additive counts of failure masks. DataFrame functions only.

1. One scan turns every document into its flags of the text filters and two
   64-bit hashes of the whole text.
2. A counting Bloom filter of the texts: every task's partial counts are its
   sketch, and the shuffle merges them. The filter is a table of blocks, so it
   grows with the input and needs no fixed size. A text that meets a counter of
   one is guaranteed unique.
3. Only possible repeats are read again and shuffled, grouped by their full
   text for the exact smallest id.
4. Flags join into a mask per document. Counts per (part, mask) add up, and all
   orders and steps follow from them without another look at a document.

Defined results: a null text counts as empty and a null language as the empty
string. A row without id repeats nothing and is repeated by nothing. Rows that
share an id are counted one by one; the texts of such rows are told apart by
their hashes, 128 bits. Labels of one id count as set where any of its rows
sets them; null and missing labels count as unset. An empty table gives no
rows. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from adloom.llm.workspace import Workspace

WHITE = "[\\x20\\x09-\\x0D]+"
#: Counters of a block, and for each text of the input; one text uses so many of one block.
BLOCK, PER_TEXT, PROBES = 1024, 16, 3
#: Letter of the filter that fails repeated texts.
REPEAT = "E"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


#: Conditions on (text, words) under which a document fails.
FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 3 * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}


def _bit(letter: str, letters: str) -> int:
    return 1 << letters.index(letter)


def _hashes(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), F.col(text)).alias("g")]


def _facts(docs: DataFrame, doc_id: str, text: str, part: str, filters: dict, letters: str) -> DataFrame:
    """(id, part, mask, h, g): everything the audit needs of a document but whether its text repeats."""
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"),
    ).withColumn("words", _words(F.col("t")))
    mask = F.lit(0)
    for letter, fails in filters.items():
        mask = mask + F.when(fails(F.col("t"), F.col("words")), _bit(letter, letters)).otherwise(0)
    return rows.select("id", "part", mask.alias("mask"), *_hashes("t"))


def _places(blocks: int) -> list[Column]:
    """The block of a text and the counters it uses there."""
    counters = [F.shiftrightunsigned("g", 10 * i).bitwiseAND(F.lit(BLOCK - 1)).cast("int") for i in range(PROBES)]
    return [F.pmod("h", F.lit(blocks)).alias("block"), F.array_distinct(F.array(*counters)).alias("counters")]


def counting_bloom(facts: DataFrame, blocks: int) -> DataFrame:
    """(block, ones): for each block, a bit for every counter that exactly one row (h, g) uses, in longs of 64 bits."""
    used = facts.select(*_places(blocks)).select("block", F.explode("counters").alias("counter"))
    single = used.groupBy("block", "counter").count().where("count = 1")
    word, bit = F.shiftright("counter", 6), F.expr("shiftleft(1L, counter & 63)")
    words = [F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0).cast("long")) for i in range(BLOCK // 64)]
    return single.groupBy("block").agg(F.array(*words).alias("ones"))


def possible_repeats(facts: DataFrame, sketch: DataFrame, blocks: int) -> DataFrame:
    """``facts`` with ``possible``: false where the sketch proves that no other row has the text."""
    placed = facts.select("*", *_places(blocks)).join(sketch, "block", "left")
    alone = F.exists("counters", lambda c: F.getbit(F.get("ones", F.shiftright(c, 6)), c.bitwiseAND(63)) == 1)
    return placed.select(*facts.columns, (~F.coalesce(alone, F.lit(False))).alias("possible"))


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    filters: dict[str, Callable[[Column, Column], Column]] = FILTERS,
    space: Workspace | None = None,
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail; bit i is the i-th letter, the last that of repeats."""
    space = space or Workspace(docs.sparkSession, "filter-audit")
    letters = "".join(filters) + REPEAT
    facts = space.stage(_facts(docs, doc_id, text, part, filters, letters), "facts")
    blocks = facts.count() * PER_TEXT // BLOCK + 1
    sketch = space.stage(counting_bloom(facts, blocks), "sketch")
    probed = space.stage(possible_repeats(facts, sketch, blocks), "probed")

    suspects = space.stage(probed.where("possible").select("h").distinct(), "suspects")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    texts = texts.withColumn("h", F.xxhash64("t")).join(suspects, "h", "left_semi")
    first = texts.groupBy("t").agg(F.min("id").alias("id")).where("id IS NOT NULL").select("id", *_hashes("t"))
    first = space.stage(first.distinct(), "first")

    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flagged = probed.join(first.withColumn("is_first", F.lit(True)), ["id", "h", "g"], "left").join(known, "id", "left")
    repeats = F.col("possible") & F.col("id").isNotNull() & F.col("is_first").isNull()
    mask = F.col("mask") + F.when(repeats, _bit(REPEAT, letters)).otherwise(0)
    return flagged.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """What every filter keeps and removes at every step of every order, for each part of ``counts``."""
    orders = ",".join("".join(p) for p in permutations(letters))
    steps = counts.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    before, here = F.lit(0), F.lit(0)
    for letter in letters:
        place, bit = F.instr("filter_order", letter), _bit(letter, letters)
        before = before + F.when(place < F.col("step"), bit).otherwise(0)
        here = here + F.when(place == F.col("step"), bit).otherwise(0)
    steps = steps.select("*", F.col("mask").bitwiseAND(before).alias("earlier"), F.col("mask").bitwiseAND(here).alias("fails"), here.alias("bit"))

    def total(condition: str, column: str = "n") -> Column:
        return F.sum(F.when(F.expr(condition), F.col(column)).otherwise(0)).cast("long").alias(column if column != "n" else "total")

    removed = "earlier = 0 AND fails <> 0"
    out = steps.groupBy("part", "filter_order", "step").agg(
        total("earlier = 0 AND fails = 0").alias("kept"),
        total(removed).alias("removed"),
        total("earlier <> 0 AND fails <> 0").alias("redundant"),
        total("mask = bit").alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
    )
    # 120 rows for five filters, whatever the documents.
    of_filter = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))
    return out.withColumn("shapley", F.sum("removed").over(of_filter))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column, Column], Column]] = FILTERS, **columns: str) -> DataFrame:
    """``interactions`` of the filters and of repeats, over all orders."""
    space = Workspace(docs.sparkSession, "filter-audit")
    counts = space.stage(mask_counts(docs, labels, filters=filters, space=space, **columns), "counts")
    space.keep_only("counts")
    return interactions(counts, "".join(filters) + REPEAT)


def audit_sql() -> str:
    """The same, order by order, for the checking engine."""
    return """
    WITH t AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
      FROM documents
    ), l AS (
      SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), f AS (
      SELECT t.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
             len(words) < 200 AS a,
             100 * len(list_distinct(words)) < 50 * len(words) AS b,
             100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id
    ), m AS (
      SELECT part, [a, b, c, d, e] AS fails, count(*) AS n,
             count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM f GROUP BY ALL
    ), letters AS (
      SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
      SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
      FROM letters p, letters q, letters r, letters s, letters u
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
    ), steps AS (
      SELECT filter_order, unnest(range(1, 6)) AS step FROM orders
    ), numbered AS (
      SELECT filter_order, step, list_transform(string_split(filter_order, ''), lambda x: ascii(x) - 64) AS ids FROM steps
    ), applied AS (
      SELECT m.*, filter_order, step, ids[step] AS f,
             len(list_filter(ids[:step - 1], lambda i: fails[i])) > 0 AS earlier, fails[ids[step]] AS here,
             len(list_filter(fails, lambda x: x)) = 1 AS once
      FROM m CROSS JOIN numbered
    ), summed AS (
      SELECT part, filter_order, step, f,
             coalesce(sum(n) FILTER (WHERE NOT earlier AND NOT here), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE NOT earlier AND here), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE earlier AND here), 0) AS redundant,
             coalesce(sum(n) FILTER (WHERE here AND once), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE NOT earlier AND here), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (WHERE NOT earlier AND here), 0) AS toxic_lost
      FROM applied GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
           unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
           (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM summed
    """
