"""Possessions: base flag, three corrections, start clock, synthetic last possession of a period.

Every function adds columns with scans whose groups contain the game, so the chain needs no shuffle beyond the one that
ordered the events.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ifelse_na, opponent, type_act
from ..operators.scan import fill_down, fill_up, following, group_last, group_sum, previous, scan

# Fixed action codes of free throws.
LAST_OF_TRIP, FREE_FLAGRANT_OR_CLEAR = (12, 15), (18, 19, 20, 25, 26, 27, 28, 29)
NOT_LAST_POSSESSION = (16,) + FREE_FLAGRANT_OR_CLEAR
KEEPS_BALL = (19, 20, 26, 29)
PERIOD_END, SYNTHETIC = 13, 99
LAST_POSSESSION_TEXT = "Last possession of quarter"  # fixed text of the synthetic event
SECOND = ["game_id", "secs_passed_game"]
PERIOD = ["game_id", "period"]
BY_EVENT = ["number_event"]


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def possession_flag(events: DataFrame) -> DataFrame:
    """1 on shots, turnovers and the last free throw of an ordinary trip."""
    return events.withColumn("possession", _flag(F.col("msg_type").isin(1, 2, 5) | type_act(3, LAST_OF_TRIP)))


def _second_facts(events: DataFrame) -> DataFrame:
    """What else happened in the second of every event, for the two corrections below."""
    tests = {"__lane_foul": type_act(6, 2), "__lane_violation": type_act(7, 3), "__made": F.col("msg_type") == 1,
             "__timeout": F.col("msg_type") == 9, "__team_rebound": (F.col("msg_type") == 4) & F.col("player1").isNull()}
    return scan(events, SECOND, BY_EVENT, {name: group_sum(_flag(test)) for name, test in tests.items()})


def mark_lane_violations(events: DataFrame) -> DataFrame:
    """Free throws (3,10) in a second with a (6,2) foul, a (7,3) violation and no made shot."""
    seen = events if "__lane_foul" in events.columns else _second_facts(events)
    lane = (type_act(3, 10) & (F.col("__lane_foul") > 0) & (F.col("__lane_violation") > 0) & (F.col("__made") == 0))
    kept = [c for c in events.columns if c not in ("__lane_foul", "__lane_violation", "__made")]
    return seen.withColumn("lane_violation", F.coalesce(lane, F.lit(False))).select(*kept, "lane_violation")


def mark_jumpball_turnovers(events: DataFrame) -> DataFrame:
    """Jump balls that hide a turnover: right after a timeout of the same team, inside one team's possessions."""
    out = events if "__timeout" in events.columns else _second_facts(events)
    challenged = (F.col("__timeout") > 0) & (F.col("__team_rebound") > 0)
    out = scan(out, ["game_id"], BY_EVENT, {"__prev": previous(F.struct(
        "msg_type", "slug_team", challenged.alias("challenged")))})
    owner = F.when(F.col("possession") == 1, F.col("off_slug_team"))
    out = scan(out, PERIOD, BY_EVENT, {"__prev_poss": fill_down(owner), "__next_poss": fill_up(owner)})
    turnover = (type_act(10, 1) & (F.col("__prev.msg_type") == 9) & (F.col("slug_team") == F.col("__prev.slug_team"))
                & (F.col("__prev_poss") == F.col("__next_poss")) & ~F.col("__prev.challenged"))
    kept = [c for c in events.columns if c not in ("__timeout", "__team_rebound")]
    return out.withColumn("jumpball_turnover", F.coalesce(turnover, F.lit(False))).select(*kept, "jumpball_turnover")


def apply_marks(events: DataFrame) -> DataFrame:
    """Turn both marks into possessions; a jump-ball turnover moves the event to the other team."""
    other = opponent(F.col("slug_team"))
    jump = F.col("jumpball_turnover")
    return events.withColumns({
        "possession": F.when(F.col("lane_violation") | jump, 1).otherwise(F.col("possession")),
        "off_slug_team": F.when(jump, other).otherwise(F.col("off_slug_team")),
        "slug_team": F.when(jump, other).otherwise(F.col("slug_team"))})


def mark_consecutive(events: DataFrame) -> DataFrame:
    """Possessions (and (6,30) fouls) followed, among such rows of the period, by one of the same team."""
    events = events.withColumn("__candidate", F.coalesce((F.col("possession") == 1) | type_act(6, 30), F.lit(False)))
    out = scan(events, PERIOD + ["__candidate"], BY_EVENT, {"__next": following(F.struct("possession", "off_slug_team"))})
    same = (F.col("__candidate") & (F.col("possession") == F.col("__next.possession"))
            & (F.col("off_slug_team") == F.col("__next.off_slug_team")))
    return out.withColumn("consecutive", F.coalesce(same, F.lit(False))).drop("__candidate", "__next")


def corrected_possessions(events: DataFrame) -> DataFrame:
    """Base flag, then lane violations, jump balls and consecutive possessions, in this order."""
    marked = mark_jumpball_turnovers(mark_lane_violations(_second_facts(possession_flag(events))))
    marked = mark_consecutive(apply_marks(marked))
    return marked.withColumn("possession", F.when(F.col("consecutive"), 0).otherwise(F.col("possession"))).drop(
        "lane_violation", "jumpball_turnover", "consecutive")


def with_possession_start(events: DataFrame) -> DataFrame:
    """``start_poss``: clock at which the running possession began.

    A rebound starts one on its own row, other changes on the row after them; if both point at one row, the earlier event
    wins. Made shots with a free throw in the same second start nothing by themselves.
    """
    change = (((F.col("possession") == 1) & (F.col("msg_type").isin(1, 5, 10) | ((F.col("msg_type") == 3) & (F.col("shot_pts") > 0))))
              | (type_act(4, 0) & (F.col("desc_value") == 0)) | type_act(3, 10) | type_act(6, 6))
    out = events.withColumn("__change", F.coalesce(change, F.lit(False)))
    out = scan(out, ["game_id", "__change"], BY_EVENT, {"__prev": previous(F.struct("msg_type", "act_type"))})
    after_foul = F.coalesce((F.col("__prev.msg_type") == 6) & (F.col("__prev.act_type") == 6), F.lit(False))
    out = out.withColumn("__change", F.col("__change") & ~(type_act(3, 10) & after_foul) & ~type_act(6, 6))
    out = scan(out, SECOND + ["slug_team"], BY_EVENT, {
        "__made": group_sum(_flag(F.col("__change") & (F.col("msg_type") == 1))),
        "__free": group_sum(_flag(F.col("__change") & (F.col("msg_type") == 3)))})
    and_one = (F.col("__made") > 0) & (F.col("__free") > 0) & F.col("msg_type").isin(1, 3)
    out = out.withColumn("__starts", F.when(F.col("__change") & ~and_one, F.col("clock")))
    # Only the previous row of the same period matters: the first row of a period starts with its own clock.
    out = scan(out, PERIOD, BY_EVENT, {"__row_before": previous(F.struct(
        F.when(F.col("msg_type") != 4, F.col("__starts")).alias("starts")))})
    start = F.when(F.col("__row_before").isNull(), F.col("clock")).otherwise(
        F.coalesce("__row_before.starts", F.when(F.col("msg_type") == 4, F.col("__starts"))))
    out = scan(out, PERIOD, BY_EVENT, {"start_poss": fill_down(start)})
    return out.select(*events.columns, "start_poss")


def last_possessions(events: DataFrame) -> DataFrame:
    """For period-end rows: team and clock of a possession still open at the end, else NULL."""
    counts = (F.col("msg_type").isin(1, 2, 3, 4, 5) & ~type_act(3, NOT_LAST_POSSESSION) & ~type_act(4, 1))
    last = scan(events, PERIOD, BY_EVENT, {"__last": group_last(F.when(counts, F.struct(
        "msg_type", "act_type", "clock", "desc_value", "slug_team", "team_home", "team_away")))})
    kind, act = F.col("__last.msg_type"), F.col("__last.act_type")
    stays = (kind == 4) | ((kind == 3) & act.isin(*KEEPS_BALL))
    team = ifelse_na(stays, F.col("__last.slug_team"),
                     opponent(F.col("__last.slug_team"), F.col("__last.team_home"), F.col("__last.team_away")))
    is_open = ((F.col("msg_type") == PERIOD_END) & (F.col("__last.clock") != "00:00.0")
               & ~((kind == 4) & (F.col("__last.desc_value") == 1)))
    return last.withColumn("open_possession", F.when(is_open, F.struct(
        team.alias("team"), F.col("__last.clock").alias("clock")))).drop("__last")


def with_last_possessions(events: DataFrame) -> DataFrame:
    """Add one synthetic event half a step before the end row of every period that ends with an open possession."""
    rows = last_possessions(events).withColumn("__copy", F.explode(
        F.when(F.col("open_possession").isNotNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    new = F.col("__copy") == 1
    values = {
        "number_event": F.col("number_event") - F.when(new, 0.5).otherwise(0.0),
        "number_original": F.when(new, 0).otherwise(F.col("number_original")),
        "msg_type": F.when(new, SYNTHETIC).otherwise(F.col("msg_type")),
        "act_type": F.when(new, 0).otherwise(F.col("act_type")),
        "possession": F.when(new, 1).otherwise(F.col("possession")),
        "start_poss": F.when(new, F.col("open_possession.clock")).otherwise(F.col("start_poss")),
        "description": F.when(new, LAST_POSSESSION_TEXT).otherwise(F.col("description")),
        "off_slug_team": F.when(new, F.col("open_possession.team")).otherwise(F.col("off_slug_team")),
        "slug_team": F.when(new, F.col("open_possession.team")).otherwise(F.col("slug_team")),
    }
    return rows.withColumns(values).drop("__copy", "open_possession")


def possessions(events: DataFrame, starts: bool = True) -> DataFrame:
    """The whole chain; without ``starts`` the clock at which a possession began is left NULL, for those who read no more than sums."""
    out = corrected_possessions(events)
    return with_last_possessions(with_possession_start(out) if starts else out.withColumn("start_poss", F.lit(None).cast("string")))
