"""The corpus pipeline: five operators in a row, each stage written as Parquet and read again.

Every stage works on all rows that the one before kept and takes (spark, docs, sf_dir). Null texts are empty; empty
tables pass through; columns besides those of documents are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.chunk_dedup import remove_repeats
from saltmarsh.llm.common import private, release, stored, tables_made
from saltmarsh.llm.ppm_language import UNKNOWN, predict_languages, train_with_limit
from saltmarsh.llm.secret_ledger import redact
from saltmarsh.llm.simhash_pivots import deduplicate
from saltmarsh.llm.vector_packing import pack_documents

#: Texts whose most likely language has less than this probability are rejected.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, in none of the languages, or in none clearly, go (without any label, only the former)."""
    model = train_with_limit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = private(docs, "_lang", "_score")
    found = predict_languages(docs, model, keep=tuple(docs.columns), names=(lang, score))
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of documents alike in their five-word shingles (0.8 or more), the least id stays."""
    return deduplicate(docs, shingle=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that an earlier document holds are cut out."""
    return remove_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret found is masked."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents and the sequence each goes to."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scans", secrets),
    ("best_fit_packing", packing),
]

#: SQL expresses neither the language model, the fingerprints nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), tables_made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, tables_made() - before - {docs.stored_at})  # nothing reads the stage's own tables and its input any more
    return docs
