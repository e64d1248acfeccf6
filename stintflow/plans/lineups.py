"""Who is on court: period starters, lineups around every substitution, lineups on every event."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import not_in, sorted_names, type_act
from ..operators.scan import CHUNK, beside, chunked, fill_down, fill_up, following, group_sum, row_count, scan
from ..operators.verbs import pivot_first

SUBSTITUTION, PERIOD_START = 8, 12
# Fixed codes: fouls whose participants may be on the bench, and the types timeout and ejection.
BENCH_FOULS, OFF_COURT_TYPES = (11, 12, 16, 18, 30), (9, 11)
LINEUP_SIZE = 5
FULL_PERIOD_MINUTES, FULL_OVERTIME_MINUTES = "10:00", "5:00"
ACTIVITY = ("fga", "fta", "reb", "ast", "stl", "blk", "turnovers", "pf")
STAY_STEP = 10_000
PERIOD_TEAM = ["game_id", "period", "slug_team"]


def roster(player_logs: DataFrame) -> DataFrame:
    """One row per (game, team, player name)."""
    return player_logs.groupBy("game_id", F.col("team_abbreviation").alias("slug_team"), "player_name").agg(
        F.min("player_id").alias("player_id"), F.min("team_location").alias("team_location"))


def team_locations(player_logs: DataFrame) -> DataFrame:
    return player_logs.groupBy("game_id", F.col("team_abbreviation").alias("slug_team")).agg(
        F.min("team_location").alias("team_location"))


def _mentions(events: DataFrame) -> DataFrame:
    """Every player an event names. For substitutions ``moved`` orders the moves: twice the event number, plus one for out.

    One number holds order and direction (inside one row "in" comes before "out"), so the first move is a plain minimum.
    """
    move = F.when(F.col("msg_type") == SUBSTITUTION, F.col("number_event").cast("bigint") * 2)
    named = F.array(F.struct(F.col("player2").alias("player_name"), move.alias("moved")),
                    F.struct(F.col("player1").alias("player_name"), (move + 1).alias("moved")),
                    F.struct(F.col("player3").alias("player_name"), F.lit(None).cast("bigint").alias("moved")))
    return events.select("game_id", "period", F.inline(named))


def _first_direction(mentions: DataFrame) -> DataFrame:
    """Per player and period the direction of the first substitution, NULL if only other events name the player."""
    first = mentions.groupBy("game_id", "period", "player_name").agg(F.min("moved").alias("moved"))
    return first.select("game_id", "period", "player_name",
                        F.when(F.col("moved") % 2 == 0, "in").when(F.col("moved") % 2 == 1, "out").alias("in_out"))


def players_subbed(events: DataFrame, player_logs: DataFrame) -> DataFrame:
    """First substitution of every player in every period; the player started it if that was going out."""
    mentions = _mentions(events.where(F.col("msg_type") == SUBSTITUTION)).where(F.col("moved").isNotNull())
    ids = roster(player_logs).groupBy("game_id", "player_name").agg(F.min("player_id").alias("player_id"))
    return (_first_direction(mentions)
            .withColumn("starter", F.when(F.col("in_out") == "out", 1).otherwise(0))
            .join(ids, ["game_id", "player_name"], "left"))


def period_starters(events: DataFrame, player_logs: DataFrame) -> DataFrame:
    """Players who began a period: named by an on-court event and not first seen coming in."""
    on_court = ~type_act(6, BENCH_FOULS) & not_in(F.col("msg_type"), OFF_COURT_TYPES)
    mentions = _mentions(events.where(F.coalesce(on_court, F.lit(True)))).where(
        F.col("player_name").isNotNull() & (F.col("player_name") != "0"))
    started = _first_direction(mentions).where(F.coalesce(F.col("in_out") == "out", F.lit(True)))
    ids = roster(player_logs).drop("team_location")
    return started.select("game_id", "period", "player_name").join(ids, ["game_id", "player_name"], "left")


def starters_missing(starters: DataFrame) -> DataFrame:
    return starters.groupBy(*PERIOD_TEAM).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != LINEUP_SIZE)


def starters_repair(starters: DataFrame, period_box: DataFrame) -> DataFrame:
    """Silent full-period players of the teams whose starters do not add up to five."""
    minutes = F.when(F.col("period") > 4, FULL_OVERTIME_MINUTES).otherwise(FULL_PERIOD_MINUTES)
    idle = sum((F.col(c).try_cast("int") for c in ACTIVITY[1:]), F.col(ACTIVITY[0]).try_cast("int")) == 0
    silent = period_box.where((F.col("min") == minutes) & idle).select(
        "game_id", "period", "player_name", F.col("player_id").try_cast("int").alias("player_id"),
        F.col("team_abbreviation").alias("slug_team"))
    return silent.join(starters_missing(starters), PERIOD_TEAM, "left_semi")


def all_starters(events: DataFrame, player_logs: DataFrame, period_box: DataFrame | None = None) -> DataFrame:
    found = period_starters(events, player_logs)
    return found if period_box is None else found.unionByName(starters_repair(found, period_box))


def starting_lineups(starters: DataFrame, player_logs: DataFrame) -> DataFrame:
    """One row per (game, period, team): the sorted starting lineup and the location of the team."""
    return (starters.groupBy(*PERIOD_TEAM).agg(sorted_names(F.collect_set("player_name")).alias("lineup_start"))
            .join(team_locations(player_logs), ["game_id", "slug_team"], "left"))


def numbered_substitutions(events: DataFrame) -> DataFrame:
    """Substitutions with their number inside (game, period, team), from 1, and how many there are."""
    subs = events.where(F.col("msg_type") == SUBSTITUTION).select(
        *PERIOD_TEAM, "number_event", F.col("player1").alias("player_out"), F.col("player2").alias("player_in"), *[c for c in events.columns if c == CHUNK])
    return scan(subs, PERIOD_TEAM, ["number_event"], {"nth": row_count(), "n_subs": group_sum(F.lit(1).cast("bigint"))})


def on_court(subs: DataFrame, starts: DataFrame) -> DataFrame:
    """Stays on court: a player is there from substitution ``since`` (0: from the start) up to, but without, substitution ``until``.

    A stay begins with a starter or with a mention as "in" and lasts until the player's next mention of either kind. Inside one substitution "in"
    comes before "out", so a player who is both is not on court after it.
    """
    cut = [c for c in subs.columns if c == CHUNK]
    mentions = subs.select(*PERIOD_TEAM, *cut, "nth", "n_subs", F.inline(F.array(
        F.struct(F.col("player_in").alias("player"), F.lit(True).alias("came"), (F.col("nth") * 2).alias("at")),
        F.struct(F.col("player_out").alias("player"), F.lit(False).alias("came"), (F.col("nth") * 2 + 1).alias("at"))))).where(F.col("player").isNotNull())
    mentions = scan(mentions, [*PERIOD_TEAM, "player"], ["at"], {"until": following(F.col("nth"))})
    came = mentions.where("came").select(*PERIOD_TEAM, "player", F.col("nth").alias("since"), F.coalesce("until", F.col("n_subs") + 1).alias("until"))
    first = mentions.groupBy(*PERIOD_TEAM, "player").agg(F.min("nth").alias("until"))
    counts = subs.groupBy(*PERIOD_TEAM).agg(F.max("n_subs").alias("n_subs"))
    began = (starts if cut else beside(starts, subs, "game_id")).select(*PERIOD_TEAM, F.explode(F.split("lineup_start", ", ")).alias("player"))
    began = began.join(counts, PERIOD_TEAM).join(first, [*PERIOD_TEAM, "player"], "left").select(
        *PERIOD_TEAM, "player", F.lit(0).cast("bigint").alias("since"), F.coalesce("until", F.col("n_subs") + 1).alias("until"))
    return came.unionByName(began).where(F.col("until") > F.col("since"))


def lineup_changes(events: DataFrame, starts: DataFrame) -> DataFrame:
    """Lineup before and after every substitution: (lineup plus player_in) minus player_out, starting from ``starts``.

    Read off the players' stays: the lineup after a substitution is everyone whose stay covers it, the one before it those who cover its
    predecessor. The work is about the players on court for each substitution, and a group of any length is spread over its substitutions.
    """
    subs = numbered_substitutions(events)
    # Two explodes so that no single array spans a very long stay on court.
    stays = on_court(subs, starts).withColumn("span", F.explode(F.sequence(F.floor(F.col("since") / STAY_STEP), F.floor((F.col("until") - 1) / STAY_STEP))))
    covered = stays.withColumn("nth", F.explode(F.sequence(F.greatest("since", F.col("span") * STAY_STEP), F.least(F.col("until"), (F.col("span") + 1) * STAY_STEP) - 1)))
    seen = covered.select(*PERIOD_TEAM, F.inline(F.array(F.struct("nth", F.col("player").alias("after"), F.lit(None).cast("string").alias("before")),
                                                         F.struct((F.col("nth") + 1).alias("nth"), F.lit(None).cast("string").alias("after"), F.col("player").alias("before")))))
    lineups = seen.groupBy(*PERIOD_TEAM, "nth").agg(F.collect_set("before").alias("before"), F.collect_set("after").alias("after"))
    known = starts.select(*PERIOD_TEAM, "team_location", F.lit(True).alias("known"))
    joined = subs.join(beside(known, events, "game_id"), chunked(PERIOD_TEAM, subs), "left").join(lineups, [*PERIOD_TEAM, "nth"], "left")
    nobody = F.array().cast("array<string>")
    return joined.select(*chunked(PERIOD_TEAM, subs), "team_location", "number_event", *[
        F.when(F.col("known"), sorted_names(F.coalesce(side, nobody))).alias(f"lineup_{side}") for side in ("before", "after")])


def lineups_on_events(events: DataFrame, starts: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """``lineup_home`` and ``lineup_away`` on every event of a period.

    Period-start rows carry the starting lineups, substitutions their own; other rows take the last lineup known, else
    the next one.
    """
    changes = lineup_changes(events, starts) if changes is None else changes
    sides, key = ["home", "away"], ["game_id", "period", "number_event", "slug_team"]
    start_wide = pivot_first(starts, ["game_id", "period"], "team_location", ["lineup_start"], sides, ["slug_team"]
                             ).withColumn("msg_type", F.lit(PERIOD_START))
    changes = changes.withColumn("number_event", F.col("number_event").cast(events.schema["number_event"].dataType))
    cut = CHUNK in events.columns and CHUNK in changes.columns
    change_wide = changes.select(*key, *[CHUNK for _ in range(cut)], *[
        F.when(F.col("team_location") == side, F.col(name)).alias(f"{name}_{side}")
        for side in sides for name in ("lineup_before", "lineup_after")])
    marked = (events.join(beside(start_wide, events, "game_id"), chunked(["game_id", "period", "msg_type"], events), "left")
              .join(change_wide if cut else beside(change_wide, events, "game_id"), chunked(key, events), "left"))
    steps = {}
    for side in sides:
        steps[f"__down_{side}"] = fill_down(F.coalesce(f"lineup_start_{side}", f"lineup_after_{side}"))
        steps[f"__up_{side}"] = fill_up(F.coalesce(f"lineup_start_{side}", f"lineup_before_{side}"))
    filled = scan(marked, ["game_id", "period"], ["number_event"], steps)
    return filled.select(*events.columns, *[
        F.coalesce(f"__down_{side}", f"__up_{side}").alias(f"lineup_{side}") for side in sides])
