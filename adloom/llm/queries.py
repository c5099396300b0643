"""Queries of the operators over the whole tables, with production settings, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adloom.llm import curves, decontaminate, filter_audit, ftrl, grace_dedup, html_blocks, line_spread, mil, ngram_join, pieces, spelling, suffixes, warc
from adloom.llm.workspace import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


#: Documents of this remainder are held out when labels are learned.
HELD_OUT = 2


def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def op1_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return curves.nearest(vectors, F.col("vec_id") % 50 == 0, "vec_id", "embedding")


def op2_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = mil.Settings()
    model = mil.train(docs, table(spark, sf_dir, "labels"), "quality", fold() != HELD_OUT, s)
    scored = mil.score(docs, model)
    return scored.select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted")
    )


def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), html_blocks.trained())


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_spread.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op6_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = ftrl.Settings()
    model = ftrl.train(docs, table(spark, sf_dir, "labels"), "toxic", fold() != HELD_OUT, s)
    scored = ftrl.score(docs, model)
    return scored.select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score", (F.col("score") >= s.threshold).cast("int").alias("predicted")
    )


def op7_decontaminate_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digest(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


def op11_bloom_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), s=spelling.Settings(drop_one_in=199))


def op13_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace_dedup.groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert_neighbours,
        op2_quality_attention,
        op3_warc_zstd,
        op4_html_crf,
        op5_line_spread,
        op6_toxicity_ftrl,
        op7_decontaminate_templates,
        op8_sentencepiece_viterbi,
        op9_suffix_dedup,
        op10_ngram_jaccard,
        op11_bloom_audit,
        op12_spelling_composition,
        op13_grace_dedup,
        pipeline,
    )
}

ORACLES = {
    "op3_warc_zstd": """
      WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
      ), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
      SELECT page_id, payload_bytes, payload_digest,
             CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
             CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
      FROM f
    """,
    "op13_grace_dedup": """
      WITH d AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
      ), g AS (
        SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d
      )
      SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
    "op11_bloom_audit": filter_audit.audit_sql(),
    "op5_line_spread": line_spread.line_spread_sql(),
}
