"""Views that give the driver tables the shape of the landed tables (feed, player logs, period box, team game log).

Deterministic column rules only; the same rules are written as SQL in ``oracles/views.py``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .plans.season import LandedTables

FIRST_SEASON, SEASONS, TEAMS = 2022, 3, 12
PERIODS, PLAYERS_PER_TEAM = 4, 8


def season_of_game() -> Column:
    """Three seasons of games."""
    return F.lit(FIRST_SEASON) + F.col("game_id") % SEASONS


def home_id() -> Column:
    """Twelve teams; which two meet follows from the game."""
    return (F.col("game_id") % TEAMS + 1).cast("int")


def away_id() -> Column:
    return ((F.col("game_id") + 5) % TEAMS + 1).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an event feed: the user is the game, a 30-day month is four periods of 600 s in 20 s ticks.

    Every fifth game crowds its events into few seconds, every other fifth is one-sided and ends with the bench on court,
    so that rules on crowded seconds and on garbage time are met by many rows.
    """
    k, n, kind = F.col("k"), F.col("event_id"), F.col("event_type")
    base = table(spark, sf_dir, "events").select(
        F.col("event_id"), F.col("user_id").cast("int").alias("game_id"), kind,
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        ((F.dayofmonth("ts") - 1) * 4 + F.floor(F.hour("ts") / 6)).cast("int").alias("tick"))
    live = base.select(
        "game_id", (1 + F.floor(F.col("tick") / 30)).cast("int").alias("period"), F.when(F.col("game_id") % 5 == 0, F.floor(F.col("tick") / 10).cast("int") * 200).otherwise(F.col("tick") * 20).alias("secs"),
        n.alias("number_event"), k, (F.col("game_id") % 5).alias("mode"), F.when(n % 2 == 0, "h").otherwise("a").alias("side"),
        F.when(kind == "click", 1).when(kind == "view", 2).when(kind == "purchase", 3)
        .when(kind == "error", F.when(k < 60, 6).when(k < 80, 5).otherwise(7))
        .otherwise(F.when(k < 40, 8).when(k < 70, 4).when(k < 82, 9).when(k < 86, 18).otherwise(10)).alias("msg_type"))
    periods = live.select("game_id", "period").distinct()
    marks = periods.select("game_id", "period", F.inline(F.array(
        F.struct(((F.col("period") - 1) * 600).alias("secs"), (F.col("period") - 100).cast("bigint").alias("number_event"), F.lit(12).alias("msg_type")),
        F.struct((F.col("period") * 600).alias("secs"), (F.col("period") - 200).cast("bigint").alias("number_event"), F.lit(13).alias("msg_type")))))
    rows = live.unionByName(marks, allowMissingColumns=True)

    kind, side, mode = F.col("msg_type"), F.col("side"), F.col("mode")
    other = F.when(side == "h", "a").when(side == "a", "h")
    act = (F.when(kind == 3, F.when(k < 70, F.when(mode == 0, 10).otherwise(10 + k % 7)).otherwise(18 + k % 12)).when(kind == 10, 1).when(kind == 4, k % 2)
           .when(kind == 6, F.when((mode == 0) & (k % 6 == 3), 11).otherwise(F.element_at(F.array(*[F.lit(a) for a in (2, 6, 11, 14, 30, 2)]), k % 6 + 1)))
           .when(kind == 7, 3).otherwise(0)).cast("int")
    rows = rows.withColumn("act_type", act)
    act, left = F.col("act_type"), F.col("period") * 600 - F.col("secs")

    def player(team: Column, shift: int) -> Column:
        bench = F.when(F.col("period") == PERIODS, 4).otherwise(0)
        number = F.when(mode == 1, (k + shift) % 4 + bench).otherwise((k + shift) % 8)
        return F.when(team == "h", home_id() * 100 + number).when(team == "a", away_id() * 100 + number).cast("int")

    def team_id(team: Column) -> Column:
        return F.when(team == "h", home_id()).when(team == "a", away_id())
    text = (F.when(kind == 1, "Made shot").when(kind == 2, "Missed shot")
            .when(kind == 3, F.concat(F.when(k % 4 == 0, "Missed ").otherwise(""), F.lit("Free Throw"),
                                      F.when(act == 16, " Technical").otherwise("")))
            .when(kind == 6, F.when(act == 11, "Technical foul").when(act == 2, "Shooting foul (2 FT)").otherwise("Personal foul"))
            .when(kind == 8, "Substitution").when(kind == 12, "Start period").when(kind == 13, "End period").otherwise("Other"))
    return rows.select(
        "game_id", "period",
        F.concat(F.lpad(F.floor(left / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((left % 60).cast("string"), 2, "0"),
                 F.lit(".0")).alias("clock"),
        "number_event", "msg_type", "act_type",
        team_id(side).alias("team_id"), team_id(F.when(kind == 6, other).otherwise(side)).alias("off_team_id"),
        player(side, 0).alias("player1_id"), player(side, 3).alias("player2_id"),
        F.when(kind == 6, player(other, 5)).alias("player3_id"), text.alias("description"),
        F.when(kind == 3, 1).when(mode == 1, F.when(side == "h", 3).otherwise(1)).when(side.isNotNull(), 1 + k % 3).cast("int").alias("desc_value"))


def player_logs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight players per team and game, with the upper-case column names of a landed log.

    One team has another abbreviation in the second season, and every team's fourth player another name in the third.
    """
    games = table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("game_id")).distinct()
    sides = F.array(F.struct(F.lit("home").alias("side"), home_id().alias("team"), away_id().alias("other")), F.struct(F.lit("away").alias("side"), away_id().alias("team"), home_id().alias("other")))
    rows = games.select("game_id", season_of_game().alias("season"), F.inline(sides)).select("*", F.explode(F.sequence(F.lit(0), F.lit(PLAYERS_PER_TEAM - 1))).alias("n"))

    def slug(team: str) -> Column:
        return F.when((F.col(team) == 4) & (F.col("season") == FIRST_SEASON + 1), "MOV").otherwise(F.concat(F.lit("T"), F.lpad(F.col(team).cast("string"), 2, "0")))
    player = F.col("team") * 100 + F.col("n")
    return rows.select(
        F.col("game_id").cast("string").alias("GAME_ID"), F.col("season").alias("SEASON_ID"),
        F.date_add(F.make_date("season", F.lit(1), F.lit(1)), F.col("game_id") % 200).alias("GAME_DATE"), slug("team").alias("TEAM_ABBREVIATION"), F.col("team").cast("string").alias("TEAM_ID"),
        F.concat(slug("team"), F.when(F.col("side") == "home", " vs. ").otherwise(" @ "), slug("other")).alias("MATCHUP"), player.cast("string").alias("PLAYER_ID"),
        F.concat(F.lit("p"), player.cast("string"), F.when((F.col("n") == 3) & (F.col("season") == FIRST_SEASON + 2), " II").otherwise("")).alias("PLAYER_NAME"))


def player_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .plans.events import prepare_player_logs
    return prepare_player_logs(player_logs_raw(spark, sf_dir))


def period_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = player_logs(spark, sf_dir).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(PERIODS))).alias("period"))
    full = F.col("player_id") % 8 == (F.col("game_id") + F.col("period")) % 8
    return rows.select(
        "game_id", "period", "player_id", "player_name", "team_abbreviation",
        F.when(full, "10:00").otherwise("05:00").alias("min"), F.when(F.col("player_id") % 2 == 0, 0).otherwise(3).alias("fga"),
        *[F.lit(0).alias(c) for c in ("fta", "reb", "ast", "stl", "blk", "turnovers", "pf")])


def landed(spark: SparkSession, sf_dir: str) -> LandedTables:
    return LandedTables(feed(spark, sf_dir), player_logs(spark, sf_dir), period_box(spark, sf_dir))


def team_game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a team game log: two rows per game, some games without one of them."""
    orders, key, cust = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    team_a, team_h = cust % 12, (cust + 5) % 12
    name = lambda team: F.concat(F.lit("T"), team.cast("string"))
    away = F.struct(F.lit("A").alias("loc"), F.concat(name(team_a), F.lit(" @ "), name(team_h)).alias("MATCHUP"),
                    team_a.cast("int").alias("TEAM_ID"), (60 + (7 * key) % 40).cast("int").alias("PTS"))
    home = F.struct(F.lit("H").alias("loc"), F.concat(name(team_h), F.lit(" vs. "), name(team_a)).alias("MATCHUP"),
                    team_h.cast("int").alias("TEAM_ID"), (60 + (11 * key) % 40).cast("int").alias("PTS"))
    rows = orders.select("o_orderkey", "o_orderdate", F.inline(F.array(away, home)))
    kept = rows.where(~((F.col("loc") == "H") & (key % 17 == 0)) & ~((F.col("loc") == "A") & (key % 19 == 0)))
    return kept.select(
        F.year("o_orderdate").alias("SEASON_ID"), key.alias("GAME_ID"), F.col("o_orderdate").cast("date").alias("GAME_DATE"),
        "MATCHUP", F.when((F.col("loc") == "A") == (key % 2 == 0), "W").otherwise("L").alias("WL"), "TEAM_ID", "PTS",
        F.when(key % 10 == 0, "Playoffs").otherwise("Regular").alias("SEASON_TYPE"))
