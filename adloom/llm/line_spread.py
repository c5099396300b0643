"""Cross-site boilerplate lines, found by distinct-site spread. DataFrame functions only.

A line's spread is the number of distinct sites it appears on. HyperLogLog
sketches of sites per line hash merge by aggregation; lines whose estimate is
near the threshold get an exact distinct count, so the decision is exact. Lines
seen fewer times than the threshold cannot reach it and get no sketch.

A line is compared without leading and trailing spaces; empty lines are never
boilerplate. Every document loses all its boilerplate lines, however much of it
they are, but for proven copies: a text that lies on two or more sites and would
lose more than ``most_lost`` of its characters is left as it is, as copies are
the near-duplicate operators' work.

Defined results: a null text stays null with no lines; a null site counts for
no line; a null or repeated id changes nothing, as decisions hang on the line
alone; extra columns are carried through untouched. Lines are told apart by a
64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adloom.llm.workspace import Workspace, spare_name

#: Sketches of 2^12 registers: a relative standard error of 1.6 %.
LOG_REGISTERS = 12
#: Estimates within this share of the threshold are counted exactly: over five standard errors.
NEAR = 0.1
#: Parts that the rows of a line are dealt to, so that a line on a third of all pages is no single task's work.
SALTS = 16


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _of_lines(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows (h, salt, ...) whose ``h`` is in ``lines``."""
    salted = lines.select("h", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt"))
    return rows.join(salted, ["h", "salt"], "left_semi")


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Hashes ``h`` of the lines on at least ``min_sites`` distinct sites, from rows (h, salt, site)."""
    frequent = lines.groupBy("h").count().where(F.col("count") >= min_sites).select("h")
    seen = _of_lines(lines, frequent)
    partial = seen.groupBy("h", "salt").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"))
    sketches = partial.groupBy("h").agg(F.hll_union_agg("sketch").alias("sketch"))
    estimates = sketches.select("h", F.hll_sketch_estimate("sketch").alias("sites"))
    low, high = min_sites * (1 - NEAR) - 1, min_sites * (1 + NEAR) + 1
    clear = estimates.where(F.col("sites") > high).select("h")
    near = estimates.where(F.col("sites").between(low, high)).select("h")
    exact = (
        _of_lines(seen, near)
        .where(F.col("site").isNotNull())
        .select("h", "salt", "site")
        .distinct()
        .select("h", "site")
        .distinct()
        .groupBy("h")
        .count()
        .where(F.col("count") >= min_sites)
        .select("h")
    )
    return clear.unionByName(exact)


def _copied(keyed: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """(key, copied): hashes of the texts of a key that lie on two or more sites."""
    texts = keyed.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(site).alias("site"), F.xxhash64(text).alias("h"))
    sites = texts.where(F.col("site").isNotNull()).select("h", "site").distinct().groupBy("h").count()
    salted = texts.select("k", "h", F.pmod(F.xxhash64("k"), F.lit(SALTS)).alias("salt"))
    found = _of_lines(salted, sites.where(F.col("count") > 1).select("h"))
    return found.groupBy("k").agg(F.collect_set("h").alias("copied"))


def drop_boilerplate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = 10,
    most_lost: float = 0.5,
) -> DataFrame:
    """``docs`` without boilerplate lines, plus ``n_lines`` and ``n_removed`` (names are kept free of clashes)."""
    space = Workspace(docs.sparkSession, "line-spread")
    key, parts, bad, copied = (spare_name(docs, n) for n in ("_key", "_parts", "_bad", "_copied"))
    # Decisions hang on the line alone, so documents may share a key: their sets of bad lines are merged, and each uses its own.
    keyed = docs.withColumn(key, F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)))
    lines = keyed.select(F.col(key).alias("k"), F.col(site).alias("site"), F.explode(F.split(F.col(text), "\n")).alias("line"))
    salt = F.pmod(F.xxhash64("k"), F.lit(SALTS)).alias("salt")
    lines = lines.where(F.trim("line") != "").select("k", "site", _line_key(F.col("line")).alias("h"), salt)
    lines = space.stage(lines, "lines")
    spread = space.stage(spread_lines(lines.select("h", "salt", "site"), min_sites), "spread")

    hits = _of_lines(lines.select("k", "h", "salt"), spread)
    hits = hits.groupBy("k").agg(F.collect_set("h").alias("h"))  # distinct lines of one document
    hits = hits.join(_copied(keyed, key, text, site), "k", "left")
    joined = keyed.join(hits.select(F.col("k").alias(key), F.col("h").alias(bad), F.col("copied").alias(copied)), key, "left")

    split = F.split(F.col(text), "\n")
    whole = F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    kept = F.filter(split, lambda x: ~F.array_contains(F.col(bad), _line_key(x)) | (F.trim(x) == ""))
    left = F.aggregate(F.col(parts), F.lit(0), lambda n, x: n + F.length(x))
    touched = joined.withColumn(parts, F.when(F.col(bad).isNotNull(), kept))
    a_copy = F.coalesce(F.array_contains(copied, F.xxhash64(text)), F.lit(False))
    fits = ~a_copy | (whole - left <= F.lit(most_lost) * whole)
    fits = F.col(parts).isNotNull() & fits
    n_lines, n_removed = spare_name(docs, "n_lines"), spare_name(docs, "n_removed")
    return touched.select(
        *[
            F.when(fits, F.array_join(parts, "\n")).otherwise(F.col(c)).alias(c) if c == text else F.col(f"`{c}`")
            for c in docs.columns
        ],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(split)).cast("long").alias(n_lines),
        F.when(fits, F.size(split) - F.size(parts)).otherwise(0).cast("long").alias(n_removed),
    )


def line_spread_sql(min_sites: int = 10, most_lost: float = 0.5) -> str:
    """The same by exact counts, for the checking engine; columns doc_id, text, n_lines, n_removed."""
    return f"""
    WITH line AS (
      SELECT source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents
    ), bad AS (
      SELECT line FROM line WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {min_sites}
    ), bads AS (
      SELECT coalesce(list(line), []) AS bad FROM bad
    ), copy AS (
      SELECT text AS copied FROM documents GROUP BY text HAVING count(DISTINCT source) >= 2
    ), cut AS (
      SELECT doc_id, text, string_split(text, chr(10)) AS parts,
             list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(bad, trim(x))) AS kept, copied
      FROM documents CROSS JOIN bads LEFT JOIN copy ON text = copied
    ), sized AS (
      SELECT *, length(array_to_string(parts, '')) AS whole, length(array_to_string(kept, '')) AS remains FROM cut
    ), decided AS (
      SELECT *, len(kept) < len(parts) AND (copied IS NULL OR whole - remains <= {most_lost} * whole) AS fits FROM sized
    )
    SELECT doc_id, CASE WHEN fits THEN array_to_string(kept, chr(10)) ELSE text END AS text,
           coalesce(len(parts), 0) AS n_lines, CASE WHEN fits THEN len(parts) - len(kept) ELSE 0 END AS n_removed
    FROM decided
    """
