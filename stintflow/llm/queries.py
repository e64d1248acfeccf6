"""The registered queries of this package: each operator over its whole table, and the SQL of those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import stage
from . import balanced, language, leaks, lengths, licences, manifest, minmax, negatives, packing, pages, private, quality, repeats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_repeats(spark, sf_dir):
    return repeats.report(table(spark, sf_dir, "documents"))


@query
def op2_main_text(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op3_decontamination(spark, sf_dir):
    return leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.learn(documents))


@query
def op5_licences(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return licences.scan(documents, licences.known(spark))


@query
def op6_length_histogram(spark, sf_dir):
    return lengths.suffix_sums(stage(lengths.histogram(lengths.encoded_lengths(table(spark, sf_dir, "documents")))))


@query
def op7_repetition(spark, sf_dir):
    return quality.repetition(table(spark, sf_dir, "documents"))


@query
def op8_minmax_dedup(spark, sf_dir):
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query
def op9_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op10_private(spark, sf_dir):
    return private.report(table(spark, sf_dir, "documents"))


@query
def op11_manifest(spark, sf_dir):
    return manifest.proofs(manifest.leaves_of(table(spark, sf_dir, "documents"), manifest.tampered()), siblings=False)


@query
def op12_windows(spark, sf_dir):
    return balanced.packed(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark, sf_dir):
    rows = negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return negatives.mine(rows, negatives.chosen(rows))


STATEMENTS["op3_decontamination"] = leaks.STATEMENT
STATEMENTS["op5_licences"] = licences.statement()
STATEMENTS["op7_repetition"] = quality.statement()
STATEMENTS["op13_hard_negatives"] = negatives.STATEMENT
STATEMENTS["op11_manifest"] = manifest.statement()
