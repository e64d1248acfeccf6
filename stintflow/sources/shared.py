"""Shared working folder for staged tables and round trips."""
from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MAX_BUCKETS = 100_000  # fixed value: more are refused unless the session allows them


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only for an unconfigured local run."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(folder)
    return folder


def session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _table_prefix(spark: SparkSession) -> str:
    return "staged_" + re.sub("[^a-z0-9]", "_", spark.sparkContext.applicationId.lower()) + "_"


def clear_stages(spark: SparkSession) -> None:
    """Delete everything this application staged. Call it once the results are written; frames built on it end with it."""
    for table in spark.catalog.listTables(pattern=f"{_table_prefix(spark)}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Everything staged inside is deleted at the end; results that are to stay must have been written elsewhere or collected."""
    try:
        yield
    finally:
        clear_stages(spark)


def stage(df: DataFrame, **options: str) -> DataFrame:
    """Write the frame as a table in the shared folder and continue from it. ``options`` are those of the Parquet writer.

    Cuts the lineage and, unlike a row checkpoint, lets later reads prune columns and push filters down.
    """
    path = new_path(df.sparkSession, "stage")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Like ``stage``, in buckets of ``key``: later windows, groupings and joins on it (or on it and more) read the table without an exchange.

    There are as many buckets as shuffle partitions, unless told otherwise, so a frame that was last computed inside groups of ``key`` is written
    without a shuffle of its own, and small tables shuffled on the key meet the buckets as they are.
    """
    spark = df.sparkSession
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    name = _table_prefix(spark) + uuid.uuid4().hex
    df.write.format("parquet").bucketBy(buckets, key).option("path", new_path(spark, "stage")).saveAsTable(name)
    return spark.table(name)
