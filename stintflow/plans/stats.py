"""Stints, line-up statistics, line-up index and ids."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import split_names, sum_na
from ..operators.scan import (CHUNK, MAX_GROUP_ROWS, beside, chunked, fill_down, fill_up, nulls_last, number_rows, order_chunk, row_count,
                              running_sum, scan, split_large_groups)
from .lineups import LINEUP_SIZE, SUBSTITUTION, roster
from .possessions import BY_EVENT

STINT_KEYS = ["game_id", "game_date", "period", "stint", "slug_team", "slug_opp", "lineup", "garbage_time"]
STINT_SUMS = ["pts_team", "pts_opp", "poss_team", "poss_opp", "secs_played"]
GAMES_PER_BLOCK = 4096


def with_stints(events: DataFrame) -> DataFrame:
    """``stint_home`` / ``stint_away``: 1 plus the team's own substitutions so far, carried to every event of the game."""
    sides = ("home", "away")
    out = scan(events, ["game_id", "slug_team"], BY_EVENT, {
        "__subs": running_sum(F.when(F.col("msg_type") == SUBSTITUTION, 1).otherwise(0).cast("bigint"))})
    out = out.withColumns({f"stint_{s}": F.when(F.col("slug_team") == F.col(f"team_{s}"), F.col("__subs") + 1) for s in sides})
    out = scan(out, ["game_id"], BY_EVENT, {
        **{f"__up_{s}": fill_up(F.col(f"stint_{s}")) for s in sides},
        **{f"__down_{s}": fill_down(F.col(f"stint_{s}")) for s in sides}})
    return out.withColumns({f"stint_{s}": F.coalesce(f"__up_{s}", f"__down_{s}") for s in sides}).drop(
        "__subs", *[f"__{way}_{s}" for way in ("up", "down") for s in sides])


def perspective(events: DataFrame) -> DataFrame:
    """Two rows per event, one per team with a known line-up, seen as team and opponent."""
    def side(own: str, other: str):
        return F.struct(
            F.lit(own).alias("lineup_location"), F.col(f"lineup_{own}").alias("lineup"),
            F.col(f"shot_pts_{own}").alias("pts_team"), F.col(f"shot_pts_{other}").alias("pts_opp"),
            F.col(f"poss_{own}").alias("poss_team"), F.col(f"poss_{other}").alias("poss_opp"),
            F.col(f"team_{own}").alias("slug_team"), F.col(f"team_{other}").alias("slug_opp"),
            F.col(f"stint_{own}").alias("stint"))
    return events.select("season", "game_id", "game_date", "period", "number_event", "msg_type", "description", "secs_played",
                         "garbage_time", F.inline(F.array(side("home", "away"), side("away", "home")))
                         ).where(F.col("lineup").isNotNull())


def lineup_stats_existing(events: DataFrame) -> DataFrame:
    """Points, possessions and seconds per team, stint, line-up and garbage-time flag of events that carry their stints."""
    return perspective(events).groupBy("season", *STINT_KEYS).agg(*[sum_na(F.col(c)).alias(c) for c in STINT_SUMS])


def lineup_stats(existing: DataFrame, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Stints with any activity, renumbered per game and team."""
    activity = sum((F.col(c) for c in STINT_SUMS[1:]), F.col(STINT_SUMS[0]))
    active = existing.where(activity > 0).withColumn("__stint", F.coalesce("stint", F.lit(0)))
    order = ["game_date", "period", "__stint", "slug_opp", "lineup", "garbage_time"]
    chunk = order_chunk("game_date", "period", number="__stint", rows=max_rows)
    log = split_large_groups(active, ["game_id", "slug_team"], chunk, max_rows)
    return log.apply(scan, ["game_id", "slug_team"], order, {"__number": row_count()}).frame().withColumn(
        "stint", F.col("__number")).drop("__number", "__stint")


def lineup_index(existing: DataFrame) -> DataFrame:
    """Dense id per line-up and season, in order of first appearance.

    Numbered in blocks of games, so a season is never one task.
    """
    order = ["game_id", "game_date", "period", "stint", "slug_team", "slug_opp"]  # line-ups of one place follow by name
    first = existing.groupBy("season", "lineup").agg(F.min(nulls_last(*order)).alias("first"))
    blocks = [("__games", F.floor(F.col("first.game_id") / GAMES_PER_BLOCK)),
              ("__part", F.struct(F.col("first.game_id"), F.col("first.game_date_unknown"), F.col("first.game_date"),
                                  F.col("first.period_unknown"), F.col("first.period"), F.col("first.stint_unknown"),
                                  F.floor(F.col("first.stint") / GAMES_PER_BLOCK)))]
    return number_rows(first, ["season"], ["first", "lineup"], blocks, "lineup_id").select("season", "lineup", "lineup_id")


def lineup_members(existing: DataFrame, player_logs: DataFrame, index: DataFrame) -> DataFrame:
    """One row per (season, game, team, line-up) with its id, the ids of its first five players, and of everyone in it.

    Few line-ups occur per game, so ids are looked up here once instead of in ten joins on the events.
    """
    distinct = existing.select("season", "game_id", "slug_team", "lineup").distinct()
    ids = roster(player_logs).select("game_id", "slug_team", "player_name", "player_id")
    players = distinct.select("*", F.posexplode(split_names(F.col("lineup"))).alias("slot", "player_name"))
    wide = players.join(ids, ["game_id", "slug_team", "player_name"], "left").groupBy(
        "season", "game_id", "slug_team", "lineup").agg(*[
            F.max(F.when(F.col("slot") == slot, F.col("player_id"))).alias(f"player{slot + 1}_id") for slot in range(LINEUP_SIZE)],
        F.countDistinct("slot").alias("n_players"), F.array_sort(F.collect_set(F.struct("slot", "player_id"))).alias("__all"))
    wide = wide.withColumn("player_ids", F.transform("__all", lambda one: one["player_id"])).drop("__all")
    return wide.join(index, ["season", "lineup"], "left")


def attach_lineup_ids(events: DataFrame, members: DataFrame, tasks: int | None = None) -> DataFrame:
    """``off_`` and ``def_`` line-up ids and player ids on every event: five slots, and ``player_ids`` with everyone.

    Events stored by game in ``tasks`` buckets are read as they are.
    """
    out = events if CHUNK in events.columns else events.repartition(*[tasks for _ in range(tasks is not None)], "game_id")
    for role in ("off", "def"):
        ids = {c: f"{role}_{c}" for c in members.columns if c.endswith(("_id", "player_ids", "n_players")) and c != "game_id"}
        side = members.select("season", "game_id", F.col("slug_team").alias(f"{role}_slug_team"),
                              F.col("lineup").alias(f"{role}_lineup"), *[F.col(c).alias(n) for c, n in ids.items()])
        out = out.join(beside(side, events, "game_id"), chunked(["season", "game_id", f"{role}_slug_team", f"{role}_lineup"], events), "left")
    return out
