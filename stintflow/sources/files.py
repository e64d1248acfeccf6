"""File scans and sinks. Every read and write is one Spark job over a folder, never a loop over files."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType

from ..functions import extract_first


def scan_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; types come from ``schema``, or are inferred (one extra pass) without it."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def season_from_path(pattern: str = r"(?<!\d)\d{4}(?!\d)", column: str = "season"):
    """Season of the file a row came from: the last match of ``pattern`` in the file's name (``schedule_2005.csv``), else in a
    ``key=value`` folder above it. The files of a folder that Spark wrote go by the folder's name. Other digits of the path never count."""
    # Evaluated for every row: the two last names are cut out of the long path before any pattern is tried.
    path = F.col("_metadata.file_path")
    last, above = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    own = F.when(last.startswith("part-"), above).otherwise(last)
    name = F.try_element_at(F.regexp_extract_all(own, F.lit(f"({pattern})"), F.lit(0)), F.lit(-1))
    folder = extract_first(F.regexp_extract(above, r"^[^=]+=(.+)$", 1), pattern)
    return F.coalesce(name, folder).try_cast("int").alias(column)


def scan_seasons(spark: SparkSession, folder: str, fmt: str = "parquet", schema: str | None = None,
                 season_column: str | None = "season") -> DataFrame:
    """All per-season files under a folder in one scan, rows matched by column name; the season is read from the path."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "parquet" and not schema:
        reader = reader.option("mergeSchema", True)
    rows = (reader.schema(schema) if schema else reader).load(folder)
    return rows.select("*", season_from_path(column=season_column)) if season_column else rows


def union_seasons(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is NULL, and an empty frame is harmless."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def scan_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON lines, or one document per file; a document that does not parse is kept as text in ``_corrupt``."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return reader.schema(f"{schema}, _corrupt STRING").json(path)


def pluck(docs: DataFrame, frame: str, *keep: str) -> DataFrame:
    """Rows of one named frame inside nested documents."""
    return docs.select(*keep, F.inline(F.col(frame)))


def _by_partition(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """Collect the rows of a partition into few files; a large partition is spread over several tasks by its size."""
    return df.hint("rebalance", *partition) if partition else df


def _writer(df: DataFrame, partition: Sequence[str], rebalanced: bool = True):
    """Season partitions are replaced one by one, so a rebuilt season leaves the others alone, whatever the format. Rows that lie by partition
    already need no rebalancing."""
    return (_by_partition(df, partition) if rebalanced else df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition)


def flattened(df: DataFrame) -> DataFrame:
    """Arrays as comma separated text, which CSV has no other form for."""
    lists = {f.name: F.array_join(F.col(f.name).cast("array<string>"), ",", "?") for f in df.schema.fields if isinstance(f.dataType, ArrayType)}
    return df.withColumns(lists) if lists else df


def write_csv(df: DataFrame, path: str, *partition: str, rebalanced: bool = True) -> None:
    _writer(flattened(df), partition, rebalanced).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, *partition: str, rebalanced: bool = True) -> None:
    _writer(df, partition, rebalanced).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, *partition: str, rebalanced: bool = True) -> None:
    _writer(df, partition, rebalanced).parquet(path)


WRITERS = {"csv": write_csv, "json": write_json, "parquet": write_parquet}
