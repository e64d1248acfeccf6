"""Garbage time, offence and defence line-ups."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ifelse_na, opponent, split_names
from ..operators.scan import beside, chunked, group_max, scan
from ..operators.verbs import pivot_first
from .lineups import LINEUP_SIZE
from .possessions import BY_EVENT

# Fixed thresholds of the fourth period: from this game second on, margins of at least that many points.
GARBAGE_BANDS = ((1800, 1950, 25), (1950, 2100, 20), (2100, None, 10))
GARBAGE_PERIOD, MAX_STARTERS = 4, 2


def opening_lineups(starts: DataFrame) -> DataFrame:
    """One row per game: the first-period starters of both teams."""
    return pivot_first(starts.where(F.col("period") == 1), ["game_id"], "team_location", ["lineup_start"],
                       ["home", "away"], ["slug_team"])


def with_starter_counts(events: DataFrame, starts: DataFrame, log: DataFrame | None = None) -> DataFrame:
    joined = events.join(beside(opening_lineups(starts), events if log is None else log, "game_id"), chunked(["game_id"], events), "left")
    counts = {f"total_starters_{side}": F.coalesce(F.size(F.array_intersect(
        split_names(F.col(f"lineup_{side}")), split_names(F.col(f"lineup_start_{side}")))), F.lit(0))
        for side in ("home", "away")}
    return joined.withColumns(counts).drop("lineup_start_home", "lineup_start_away")


def with_garbage_time(events: DataFrame, starts: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """``garbage_time`` 1 while the game is decided and starters sit, unless a competitive event follows. The games and chunks are those of the stored
    ``log`` that the events were computed from, if it is given."""
    out = with_starter_counts(events, starts, log)
    scored = F.col("shot_pts") > 0
    margin = (F.when(scored & (F.col("slug_team") == F.col("team_home")), F.abs(F.col("hs") - F.col("shot_pts") - F.col("vs")))
              .when(scored & (F.col("slug_team") == F.col("team_away")), F.abs(F.col("vs") - F.col("shot_pts") - F.col("hs")))
              .otherwise(F.abs(F.col("hs") - F.col("vs"))))
    out = out.withColumn("margin_before", margin)
    secs = F.col("secs_passed_game")
    decided = F.lit(False)
    for start, end, points in GARBAGE_BANDS:
        inside = (secs >= start) & (secs < end) if end else secs >= start
        decided = decided | (inside & (F.col("margin_before") >= points))
    benched = F.col("total_starters_home") + F.col("total_starters_away") <= MAX_STARTERS
    raw = F.when(decided & benched & (F.col("period") == GARBAGE_PERIOD), 1).otherwise(0)
    out = out.withColumn("garbage_time", raw)
    out = scan(out, ["game_id"], BY_EVENT, {"__competitive": group_max(F.when(F.col("garbage_time") == 0, F.col("number_event")))})
    undone = (F.col("garbage_time") == 1) & (F.col("number_event") < F.coalesce("__competitive", F.lit(float("-inf"))))
    return out.withColumn("garbage_time", F.when(undone, 0).otherwise(F.col("garbage_time"))).drop("__competitive")


def with_off_def_lineups(events: DataFrame) -> DataFrame:
    """Defending team, line-ups of both roles, and one column per player slot; missing slots are NULL."""
    off, home, away = F.col("off_slug_team"), F.col("team_home"), F.col("team_away")
    out = events.withColumns({
        "def_slug_team": F.when(off == away, home).when(off == home, away),
        "off_lineup": F.when(off == home, F.col("lineup_home")).when(off == away, F.col("lineup_away")),
        "def_lineup": F.when(off == away, F.col("lineup_home")).when(off == home, F.col("lineup_away"))})
    return out.withColumns({f"{role}_player{slot}": F.get(split_names(F.col(f"{role}_lineup")), slot - 1)
                            for role in ("off", "def") for slot in range(1, LINEUP_SIZE + 1)})
