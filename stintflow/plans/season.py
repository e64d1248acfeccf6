"""The whole chain for landed tables, and its published tables."""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..operators.scan import MAX_GROUP_ROWS, EventLog, beside, chunked, settled
from ..sources.shared import stage
from . import events as ev, fouls, garbage, lineups, possessions, stats


class LandedTables(NamedTuple):
    """Inputs of a build; they may hold any number of seasons."""

    feed: DataFrame
    player_logs: DataFrame
    period_box: DataFrame | None = None


class SeasonTables(NamedTuple):
    play_by_play: DataFrame | None
    lineup_index: DataFrame
    lineup_stats: DataFrame
    lineup_stats_existing: DataFrame


def starting_lineups(log: EventLog, tables: LandedTables) -> DataFrame:
    starters = lineups.all_starters(log.frame(), tables.player_logs, tables.period_box)
    return stage(lineups.starting_lineups(starters, tables.player_logs))


def with_lineups(log: EventLog, tables: LandedTables) -> EventLog:
    """Line-ups on every event, without the later steps."""
    return log.apply(lineups.lineups_on_events, starting_lineups(log, tables))


# Read by the possession and foul steps only, so not kept where the play-by-play is not asked for.
STEP_COLUMNS = ("clock", "start_poss", "number_original", "act_type", "desc_value", "possession", "off_slug_team", "player1", "player2", "player3", "opt2", "ord",
                "loc_x", "loc_y")


def _enrich(part: DataFrame, starts: DataFrame, calendar: DataFrame, play_by_play: bool = True) -> DataFrame:
    """Events are stored by game, in as many buckets as their rows need, and are not shuffled: every scan and join below works inside a game. (Asked to
    partition them, the engine would deal them over its own number of partitions, however many rows that makes.) Large games are stored by their chunks.

    Line-ups come after the possession steps because those only need scans; a synthetic last event takes the line-ups of
    the rows around it.

    Large games are stored twice on the way, so that the summaries of a scan do not go back to the first of all scans; what the play-by-play alone needs
    is left out there, as the engine leaves it out for ordinary games. Stints come before the line-ups, which they do not read.
    """
    out = stats.with_stints(fouls.with_points_and_possessions(settled(possessions.possessions(part, play_by_play))))
    if not play_by_play:
        out = out.drop(*STEP_COLUMNS).withColumn("description", F.lit(None).cast("string"))
    out = lineups.lineups_on_events(settled(out), starts, settled(lineups.lineup_changes(part, starts)))
    out = garbage.with_garbage_time(out, starts, part)
    return out.join(beside(calendar, part, "game_id"), chunked(["game_id"], part), "left")


def _enriched(tables: LandedTables, max_rows: int, season: int | None, play_by_play: bool = True) -> EventLog:
    log = ev.sequence_events(tables.feed, tables.player_logs, max_rows).stored_by("game_id")
    return log.apply(_enrich, starting_lineups(log, tables), ev.game_calendar(tables.player_logs, season), play_by_play)


def enriched_events(tables: LandedTables, max_rows: int = MAX_GROUP_ROWS, season: int | None = None) -> EventLog:
    """Feed -> events with line-ups, possessions, points, garbage time, roles and stints."""
    return _enriched(tables, max_rows, season).apply(garbage.with_off_def_lineups)


def existing_stats(log: EventLog) -> DataFrame:
    """Stint sums of all parts; a game is in one part only, so parts never share a key."""
    return log.apply(stats.lineup_stats_existing).frame()


def build_season(tables: LandedTables, max_rows: int = MAX_GROUP_ROWS, season: int | None = None, play_by_play: bool = True) -> SeasonTables:
    """All tables of a build, for the season asked for or for each game's own. Two things are staged because several outputs read them: events, stored
    by game, and stint sums. Without the play-by-play only the sums read the events, and just the columns they need are computed and nothing of them stored.

    What follows from one row (roles, players by slot) is not stored but computed when the events are read.
    """
    log = _enriched(tables, max_rows, season, play_by_play)
    log = log.stored_by("game_id") if play_by_play else log
    existing = stage(existing_stats(log))
    index = stage(stats.lineup_index(existing))
    active = stats.lineup_stats(existing, max_rows).join(index, ["season", "lineup"], "left")
    if not play_by_play:
        return SeasonTables(None, index, active, existing)
    members = stats.lineup_members(existing, tables.player_logs, index)
    placed = log.apply(garbage.with_off_def_lineups).apply(stats.attach_lineup_ids, members, log.tasks)
    return SeasonTables(placed.frame().drop("stint_home", "stint_away"), index, active, existing)
