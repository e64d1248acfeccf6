"""Dataset registry, provenance, and publishing of per-season datasets in several formats."""
from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import whole_number
from .files import WRITERS, scan_seasons, union_seasons
from .shared import stage

# The leagues (name, title, source of the data) and the four tables kept for each of them.
LEAGUES = (("college", "College basketball", "broadcaster"), ("pro", "Professional basketball", "broadcaster"),
           ("pro_stats", "Professional basketball", "league statistics"))
TABLES = (("schedules", "schedules"), ("team_box", "team box scores"), ("player_box", "player box scores"), ("pbp", "play-by-play"))


class Dataset(NamedTuple):
    name: str
    title: str


def datasets(leagues: Sequence = LEAGUES, tables: Sequence = TABLES) -> list[Dataset]:
    """Every dataset: a name and a title per league and table."""
    return [Dataset(f"{league}_{table}", f"{title} {text} (from {source})")
            for league, title, source in leagues for table, text in tables]


REGISTRY = "dataset STRING, title STRING, source STRING"


def save_registry(spark: SparkSession, rows: Sequence[tuple[str, str, str]], path: str) -> DataFrame:
    """The registry of datasets as a stored table: name, title and the folder that each is read from."""
    spark.createDataFrame(rows, REGISTRY).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(REGISTRY).parquet(path)


def counted_registry(config: DataFrame) -> DataFrame:
    """The registry with the number of rows of every dataset, from the footers of its files."""
    spark = config.sparkSession
    counts = [spark.read.parquet(row.source).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(row.dataset).alias("dataset"), "n_rows") for row in config.toLocalIterator()]
    return config.join(union_seasons(counts), "dataset", "left").select("dataset", "title", "n_rows")


def stamp(df: DataFrame, text: str, updated_at: datetime.datetime | None = None) -> DataFrame:
    """Provenance columns: what the rows are and when they were published (one moment for the whole frame)."""
    return df.withColumns({"_source": F.lit(text), "_updated_at": F.lit(updated_at or datetime.datetime.now())})


def schedule_types(df: DataFrame) -> DataFrame:
    """Schedules of different seasons disagree on three column types; this settles them."""
    return df.withColumns({"id": whole_number(F.col("id")), "game_id": whole_number(F.col("game_id")),
                           "status_display_clock": F.col("status_display_clock").cast("string")})


def publish(df: DataFrame, folder: str, dataset: str, formats: Sequence[str] = ("csv", "parquet"), updated_at: datetime.datetime | None = None) -> dict[str, str]:
    """Write a dataset once per format, one partition per season.

    The frame is computed and shuffled to its seasons once, for the Parquet files; the other formats are copied from those, file by file, so no further
    copy is staged. Of a stamped frame only the rows of its moment are copied, so seasons of earlier runs are not written again. Without
    Parquet among the formats the frame is staged instead.
    """
    paths = {fmt: f"{folder}/{dataset}/{fmt}" for fmt in formats}
    if "parquet" not in formats:
        df = stage(df)
        for fmt, path in paths.items():
            WRITERS[fmt](df, path, "season")
        return paths
    WRITERS["parquet"](df, paths["parquet"], "season")
    stored = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"]).select(*df.columns)
    if updated_at is not None:
        stored = stored.where(F.col("_updated_at") == F.lit(updated_at))
    for fmt, path in paths.items():
        if fmt != "parquet":
            WRITERS[fmt](stored, path, "season", rebalanced=False)
    return paths


# Table -> settling of column types before publishing.
PREPARE: dict[str, Callable[[DataFrame], DataFrame]] = {"schedules": schedule_types}


def republish(spark: SparkSession, dataset: Dataset, source: str, folder: str, *, fmt: str = "parquet",
              schema: str | None = None, updated_at: datetime.datetime | None = None,
              formats: Sequence[str] = ("csv", "parquet")) -> dict[str, str]:
    """Per-season files of one dataset, in any readable format, to stamped files with the season from the path."""
    rows = scan_seasons(spark, source, fmt, schema)
    prepare = next((fn for table, fn in PREPARE.items() if dataset.name.endswith(table)), None)
    when = updated_at or datetime.datetime.now()
    return publish(stamp(prepare(rows) if prepare else rows, dataset.title, when), folder, dataset.name, formats, when)


def republish_all(spark: SparkSession, config: DataFrame, folder: str, **options) -> dict[str, dict[str, str]]:
    """Republish every dataset of a configuration table (``dataset, title, source``: one short row per dataset)."""
    return {row.dataset: republish(spark, Dataset(row.dataset, row.title), row.source, folder, **options) for row in config.toLocalIterator()}


def write_season_outputs(tables: dict[str, DataFrame], folder: str, formats: Sequence[str] = ("csv", "parquet"),
                         updated_at: datetime.datetime | None = None) -> dict[str, dict[str, str]]:
    """Stamp and publish the tables of a season build."""
    when = updated_at or datetime.datetime.now()
    return {name: publish(stamp(df, f"Play-by-play {name.replace('_', ' ')}", when), folder, name, formats, when) for name, df in tables.items()}
