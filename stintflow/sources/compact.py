"""JSON compaction: many small documents into few files of one compact document per line."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def compact_json(text: Column) -> Column:
    """The document without insignificant whitespace. Keys are ordered and numbers normalised; invalid text gives NULL."""
    return F.to_json(F.try_parse_json(text))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: its text, and its id from the name ``{id}.json``, or else from a ``key={id}`` folder above it."""
    own = F.regexp_extract(F.col("_metadata.file_name"), r"^(-?[0-9]+)\.json$", 1)
    above = F.regexp_extract(F.col("_metadata.file_path"), r"=(-?[0-9]+)/[^/]*$", 1)
    return spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True).select(
        F.coalesce(own.try_cast("bigint"), above.try_cast("bigint")).alias("doc_id"), F.col("value").alias("doc"))


def compact_folder(spark: SparkSession, source: str, target: str, files: int | None = None) -> None:
    """Rewrite a folder of small documents into ``target`` as (doc_id, doc) lines; the source is never touched.

    A document that does not parse keeps its text in ``_corrupt``. ``files`` spreads the parsed documents, so the parsing itself stays parallel.
    """
    docs = read_documents(spark, source).withColumn("parsed", compact_json(F.col("doc")))
    docs = docs.select("doc_id", F.col("parsed").alias("doc"), F.when(F.col("parsed").isNull(), F.col("doc")).alias("_corrupt"))
    (docs.repartition(files) if files else docs).write.mode("overwrite").json(target)
