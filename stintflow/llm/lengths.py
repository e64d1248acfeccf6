"""Exact histogram of encoded lengths, and suffix sums that answer every context limit from it.

Defined results: a NULL or empty text has length 0; repeated rows count as often as they occur; an empty table gives an empty histogram.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .tokens import Encoder, distinct_texts, vocabulary_path

# Lengths whose suffix sums are taken in one task.
BLOCK = 4096


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, length`` of every row."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            code, texts = distinct_texts(batch.column("text"))
            sizes = np.array([len(encoder.ids(t.as_py())) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes[code])], ["doc_id", "length"])
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, length long")


def histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each length that occurs: documents and tokens of exactly and of at least that length, the tokens left when every document is
    truncated to it, and the documents below it. Blocks of lengths are summed on their own and then moved by the blocks above."""
    rows = counts.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / BLOCK).alias("block"))
    within = W.partitionBy("block").orderBy(F.desc("length"))
    above = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    everything = W.partitionBy()
    moved = totals.select("block", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("docs", "tokens")],
                          *[F.sum(c).over(everything).alias(f"all_{c}") for c in ("docs", "tokens")])
    summed = rows.select("*", F.sum("n_docs").over(within).alias("docs"), F.sum("n_tokens").over(within).alias("tokens")).join(moved, "block")
    docs, tokens = F.col("docs") + F.col("docs_above"), F.col("tokens") + F.col("tokens_above")
    return summed.select("length", "n_docs", "n_tokens", docs.alias("docs_at_least"), tokens.alias("tokens_at_least"),
                         (F.col("all_tokens") - tokens + F.col("length") * docs).alias("truncated_tokens"),
                         (F.col("all_docs") - docs).alias("docs_below"), "all_docs", "all_tokens")


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens that remain, and documents that are cut, at any context limit."""
    over = F.col("length") > limit
    return sums.agg(F.coalesce(F.sum(F.least("length", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"),
                    F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("cut_docs"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least this share of the documents does not exceed."""
    return sums.where(F.col("docs_below") + F.col("n_docs") >= F.lit(share) * F.col("all_docs")).agg(F.min("length").alias("length"))
