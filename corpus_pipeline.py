"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's input.

1. toxicity: documents that the FTRL model rejects go.
2. line spread: boilerplate lines that many sites share go; documents stay, and
   whole copies that lie on several sites keep their text for the next stage.
3. n-gram Jaccard join: one document of each group of near duplicates stays.
4. benchmark decontamination: documents that leak a benchmark item go.
5. SentencePiece: the ids of every document's text.

Stages 1 to 4 return the columns of documents. A null or empty text passes
every stage and gets no ids. Each stage works on all its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adloom.llm import decontaminate, ftrl, line_spread, ngram_join, pieces
from adloom.llm.queries import HELD_OUT, fold, table
from adloom.llm.workspace import Workspace

#: Stages 1 and 5 are models and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop toxic documents. Labels are learned from the whole documents table, by the folds of the toxicity query."""
    learned = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = ftrl.Settings()
    model = ftrl.train(learned, table(spark, sf_dir, "labels"), "toxic", fold() != HELD_OUT, settings)
    scored = ftrl.score(docs, model, "toxicity_score")  # the last column, by whatever name is free
    return scored.where(F.col(scored.columns[-1]) < settings.threshold).select(*docs.columns)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that many sites share; n_chars follows the text."""
    cleaned = line_spread.drop_boilerplate(docs).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group: shingles of five words, Jaccard of 0.8 or more."""
    table(spark, sf_dir, "documents")
    return ngram_join.keep_first(docs, size=5, percent=80).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids) of every document."""
    table(spark, sf_dir, "documents")
    model = pieces.read_model(spark, pieces.DEFAULT_MODEL)
    encoded = pieces.encode(docs.select("doc_id", "text"), model)
    return encoded.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"))


STAGES = [
    ("toxicity", toxicity),
    ("line spread", boilerplate),
    ("n-gram join", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table."""
    docs = table(spark, sf_dir, "documents")
    space = Workspace(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = space.stage(stage(spark, docs, str(sf_dir).rstrip("/")), f"stage-{i}")
        if i:
            space.drop(f"stage-{i - 1}")
    return docs
