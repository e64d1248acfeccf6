"""Event preparation: player logs, names, teams, clock, event order, running score."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ifelse_na, seconds_passed_game, whole_number
from ..operators.scan import MAX_GROUP_ROWS, EventLog, order_chunk, row_count, running_sum, scan, split_large_groups
from ..operators.verbs import clean_names, join_null_safe, pivot_first, select_any

REPLAY, SCORING_TYPES = 18, (1, 2, 3)
SALTS = 997
ANY_SEASON = -1

# Fixed column names of the event feed, new name -> landed name.
FEED_COLUMNS = {
    "game_id": "game_id", "period": "period", "clock": "clock", "number_event": "number_event",
    "msg_type": "msg_type", "act_type": "act_type", "slug_team": "slug_team", "off_slug_team": "off_slug_team",
    "player1": "player1", "player2": "player2", "player3": "player3", "description": "description",
    "desc_value": "desc_value", "opt2": "opt2", "hs": "hs", "vs": "vs", "ord": "ord", "loc_x": "loc_x", "loc_y": "loc_y",
}


def prepare_player_logs(raw: DataFrame) -> DataFrame:
    """Snake-case names, integer ids, and ``team_location`` from the ``@`` of an away matchup."""
    logs = clean_names(raw)
    ids = [c for c in ("game_id", "player_id", "team_id") if c in logs.columns]
    return logs.withColumns({
        **{c: whole_number(F.col(c)) for c in ids},
        "team_location": ifelse_na(F.col("matchup").rlike("@"), F.lit("away"), F.lit("home"))})


def season_of(season_id, season: int | None = None):
    """The season asked for, or else the year in a season id (``22023`` -> 2023)."""
    return F.lit(season) if season is not None else whole_number(F.col(season_id)) % 10000


def game_calendar(player_logs: DataFrame, season: int | None = None) -> DataFrame:
    """One row per game: its date and season."""
    return player_logs.groupBy("game_id").agg(F.min(F.col("game_date").cast("date")).alias("game_date"), F.min("season_id").alias("season_id")) \
        .select("game_id", "game_date", season_of("season_id", season).alias("season"))


def season_lookup(player_logs: DataFrame, key: str, value: str, new_value: str) -> DataFrame:
    """One row per season and id: players and teams change their names between seasons. The smallest of conflicting names wins. Under ``ANY_SEASON``
    stand the ids that have one name in all seasons."""
    known = player_logs.where(F.col(key).isNotNull()).groupBy(F.col("season_id").alias("__season"), F.col(key).cast("bigint").alias("__id")).agg(F.min(value).alias(new_value))
    always = known.groupBy("__id").agg(F.min(new_value).alias("low"), F.max(new_value).alias("high")).where("low = high")
    return known.unionByName(always.select(F.lit(ANY_SEASON).cast(player_logs.schema["season_id"].dataType).alias("__season"), "__id", F.col("low").alias(new_value)))


def attach_names(feed: DataFrame, player_logs: DataFrame) -> DataFrame:
    """Player names and team slugs for the ids of the feed, as they were in the season of the game. Every lookup has one row per season and id.

    The lookups hold one row per season and player or team, so they are normally broadcast (by measured size, never by hint). Where
    they are not, most rows have no second or third player: a salt spreads those rows instead of sending all to one task.
    """
    if "season_id" not in player_logs.columns:
        player_logs = player_logs.withColumn("season_id", F.lit(0))
    seasons = player_logs.groupBy("game_id").agg(F.min("season_id").alias("__season"))
    named = join_null_safe(feed, seasons, ["game_id"], "left")
    # A game that the logs lack goes by the season of its own feed, if it says one, and else by the names that all seasons agree on.
    stated = F.col("season_id").cast(player_logs.schema["season_id"].dataType) if "season_id" in feed.columns else F.lit(None)
    named = named.withColumn("__season", F.coalesce("__season", stated, F.lit(ANY_SEASON).cast(player_logs.schema["season_id"].dataType)))
    nobody = -2 * F.pmod(F.col("number_event"), F.lit(SALTS)) - 1  # odd and negative: equals no doubled id
    for slot in (1, 2, 3):
        key = F.col(f"player{slot}_id").cast("bigint")
        names = season_lookup(player_logs, "player_id", "player_name", f"player{slot}")
        named = named.withColumn("__key", F.when(key.isNull(), nobody).otherwise(key * 2)).join(
            names.select("__season", (F.col("__id") * 2).alias("__key"), f"player{slot}"), ["__season", "__key"], "left").drop("__key")
    for key, slug in (("team_id", "slug_team"), ("off_team_id", "off_slug_team")):
        slugs = season_lookup(player_logs, "team_id", "team_abbreviation", slug)
        named = named.withColumn("__id", F.col(key).cast("bigint")).join(slugs, ["__season", "__id"], "left").drop("__id")
    return select_any(named, FEED_COLUMNS)


def game_teams(player_logs: DataFrame) -> DataFrame:
    """One row per game with ``team_home`` and ``team_away``."""
    return pivot_first(player_logs, ["game_id"], "team_location", ["team_abbreviation"], ["home", "away"],
                       ["team_abbreviation"], names="team_{level}")


def with_clock(events: DataFrame) -> DataFrame:
    return events.withColumn("secs_passed_game", seconds_passed_game(F.col("period"), F.col("clock")))


def with_points(events: DataFrame) -> DataFrame:
    """``shot_pts``: the described value of a scoring event that is not a miss, else 0."""
    scores = F.col("msg_type").isin(*SCORING_TYPES) & ~F.col("description").contains("Missed")
    return events.withColumn("shot_pts", F.col("desc_value") * ifelse_na(scores, F.lit(1), F.lit(0)))


def number_and_score(events: DataFrame) -> DataFrame:
    """Number the events of a game 1..n by game second and keep a running score, in one pass over the order."""
    def team_points(team: str):
        return running_sum(F.coalesce(ifelse_na(F.col("slug_team") == F.col(team), F.col("shot_pts"), F.lit(0)),
                                      F.lit(0)).cast("bigint"))
    return scan(events, ["game_id"], ["secs_passed_game", "number_original"],
                {"number_event": row_count(), "hs": team_points("team_home"), "vs": team_points("team_away")})


def sequence_events(feed: DataFrame, player_logs: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> EventLog:
    """Landed feed -> ordered, named and scored event log (one shuffle of the events, on the game)."""
    events = attach_names(feed, player_logs) if "player1_id" in feed.columns else select_any(feed, FEED_COLUMNS)
    events = events.join(game_teams(player_logs), "game_id", "left").where(F.col("msg_type") != REPLAY)
    events = with_points(with_clock(events.withColumnRenamed("number_event", "number_original")))
    chunk = order_chunk("secs_passed_game", number="number_original", rows=max_rows)
    return split_large_groups(events, ["game_id"], chunk, max_rows, counted=feed).apply(number_and_score)
