"""Schedules: away and home halves of a team game log joined into one row per game."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ifelse_na
from ..sources.files import write_csv, write_parquet
from ..operators.verbs import columns_first, prefix_columns
from .events import season_of

GAME_KEYS = ["GAME_ID", "SEASON_ID", "GAME_DATE"]


def pair_schedule(team_games: DataFrame, keep_wl: bool = True) -> DataFrame:
    """Away rows with their home rows; a game without an away row vanishes, one without a home row keeps NULLs.

    The away ``MATCHUP`` (with ``@``) names the game. Both halves share the game keys, so the join shuffles once per half.
    """
    games = team_games if keep_wl else team_games.drop("WL")
    sided = games.withColumn("HOME_AWAY", ifelse_na(F.col("MATCHUP").rlike("@"), F.lit("AWAY"), F.lit("HOME")))
    away = columns_first(sided.where(F.col("HOME_AWAY") == "AWAY").drop("HOME_AWAY"), "SEASON_ID", "GAME_ID", "GAME_DATE", "MATCHUP")
    home = columns_first(sided.where(F.col("HOME_AWAY") == "HOME").drop("HOME_AWAY", "MATCHUP"), "SEASON_ID", "GAME_ID", "GAME_DATE")
    away = prefix_columns(away, "AWAY_", away.columns[4:])
    home = prefix_columns(home, "HOME_", home.columns[3:])
    return away.join(home, GAME_KEYS, "left")


def season_schedule(regular: DataFrame, playoffs: DataFrame, season: int | None = None) -> DataFrame:
    """Regular season and playoffs, each paired, with the ``Season`` they were asked for (or that of their season id)."""
    both = pair_schedule(regular).unionByName(pair_schedule(playoffs), allowMissingColumns=True)
    return both.withColumn("Season", season_of("SEASON_ID", season))


def master_schedule(spark, folder: str) -> DataFrame:
    """All season files of a folder as one frame; columns that some seasons lack are NULL there."""
    return spark.read.option("mergeSchema", True).parquet(folder)


def write_schedules(schedule: DataFrame, folder: str) -> dict[str, str]:
    """The schedule per season (partitions, replaced one by one) and as one master table, each as CSV and Parquet.

    The master tables are made from all season files of the folder, so seasons written earlier are in them as well.
    """
    rows = schedule.drop("SEASON_ID").withColumnRenamed("Season", "season") if "Season" in schedule.columns else schedule.withColumnRenamed("SEASON_ID", "season")
    paths = {fmt: f"{folder}/{fmt}" for fmt in ("csv", "parquet", "master_csv", "master_parquet")}
    write_parquet(rows, paths["parquet"], "season")
    seasons = master_schedule(schedule.sparkSession, paths["parquet"])
    write_csv(rows, paths["csv"], "season")
    write_parquet(seasons, paths["master_parquet"])
    write_csv(seasons, paths["master_csv"])
    return paths
