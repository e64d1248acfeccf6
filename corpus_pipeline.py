"""From raw documents to packed training sequences: ``STAGES``, each applied to what its predecessor kept and written as a table.

Every stage takes and keeps the columns of ``documents`` only, so further columns cannot clash with its own; the last gives the packed pieces.
NULL and empty texts fail the quality rules; an empty table passes every stage; of repeated rows, and of copies without doc_id, one row stays at the near
duplicates; rows that share a doc_id are judged by their texts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stintflow.llm import leaks, minmax, packing, private, quality
from stintflow.sources.shared import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.keep_good(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity of 0.8 or more."""
    return minmax.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return leaks.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by its kind; n_chars follows the text."""
    return private.masked(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of 1024."""
    return packing.packed(docs.select(*COLUMNS))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("benchmark decontamination", decontamination),
          ("personal data", personal_data), ("best-fit packing", best_fit)]

# Rolling hashes, signatures and tokenizers are beyond SQL; the tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
