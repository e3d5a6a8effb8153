"""Training corpus pipeline over the ``documents`` table.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet in the shared folder and read back as the next stage's ``docs``. All
stages but the last return the columns of ``documents``; the last returns one
row per copy the mix takes, with a struct ``mix`` beside those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import decontaminate, langid, minhash, mixing, recompression
from depotlens.llm.store import stored, table, tidy


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; texts without letters and texts between languages go."""
    return langid.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near copies (five-word shingles, similarity 0.8).

    Rows that repeat a doc_id are one document and stay or go together; rows without a doc_id stay.
    """
    found = minhash.near_duplicates(docs, minhash.NearParams(shingle=5, similarity=80))
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that an earlier document (or an earlier place of the same one) has are cut out.

    n_chars follows the text. A document that loses every word goes.
    """
    others = [c for c in docs.columns if c != "text"]
    cut = recompression.repeated_passages(docs, carry=others).where("n_removed = 0 OR n_removed < n_words")
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("kept_text").alias(c))
        elif c == "n_chars":
            length = F.char_length("kept_text").cast(docs.schema[c].dataType)
            columns.append(F.when(F.col("n_removed") > 0, length).otherwise(F.col("doc.n_chars")).alias(c))
        else:
            columns.append(F.col(f"doc.`{c}`").alias(c))
    return cut.select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    leaks = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).where("doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: every document once per copy taken."""
    return mixing.mixed(docs)


STAGES = [
    ("language id", language_id),
    ("near-duplicate documents", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mixing),
]

#: SQL cannot express the trained language model nor the shingle and recompression hashes; tests compare with brute force.
ORACLE_SQL = None


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
