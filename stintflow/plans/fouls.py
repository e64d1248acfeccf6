"""Free throws attributed to the foul that caused them, and final points and possessions per event.

Free throws and fouls meet inside one second of one game. The totals of the free throws of a link group are put on the
fouls of that group with group sums, so matching pairs are never listed, however many events share a second.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ifelse_na, not_in, opponent, replace_first, type_act
from ..operators.scan import following, group_min, group_sum, previous, row_count, scan
from .possessions import BY_EVENT, FREE_FLAGRANT_OR_CLEAR, PERIOD, SECOND, SYNTHETIC

FREE_THROW, FOUL = 3, 6
FLAGRANT_OR_CLEAR_FOULS = (9, 14, 15)
TECHNICAL_TEXT, DOUBLE_TEXT, FREE_THROW_TEXT = "Technical|Defense 3 Second", "Double Technical", "FT"
TOTALS = ("total_fta", "shot_pts_home", "shot_pts_away", "poss_home", "poss_away")


def mark_double_technicals(events: DataFrame) -> DataFrame:
    """Two neighbouring (6,11) fouls of different teams in one second; timeouts and ejections do not separate them."""
    events = events.withColumn("__live", not_in(F.col("msg_type"), (9, 11, SYNTHETIC)))
    me = F.struct("secs_passed_game", "msg_type", "act_type", "slug_team")
    out = scan(events, ["game_id", "__live"], BY_EVENT, {"__before": previous(me), "__after": following(me)})

    def opposite(neighbour: str) -> Column:
        return F.coalesce((F.col(f"{neighbour}.secs_passed_game") == F.col("secs_passed_game"))
                          & (F.col(f"{neighbour}.msg_type") == 6) & (F.col(f"{neighbour}.act_type") == 11)
                          & (F.col(f"{neighbour}.slug_team") != F.col("slug_team")), F.lit(False))
    double = F.col("__live") & type_act(6, 11) & (opposite("__before") | opposite("__after"))
    return out.withColumn("double_technical", F.coalesce(double, F.lit(False))).drop("__live", "__before", "__after")


def double_technical_text() -> Column:
    return F.when(F.col("double_technical"), replace_first(F.col("description"), "Technical", DOUBLE_TEXT)).otherwise(
        F.col("description"))


def number_technicals(events: DataFrame) -> DataFrame:
    """``tech_number``: n-th technical free throw or n-th technical foul of its second, NULL on other events."""
    marked = mark_double_technicals(events)
    text = double_technical_text()
    tech = F.coalesce(text.rlike(TECHNICAL_TEXT) & ~text.contains(DOUBLE_TEXT) & (F.col("msg_type") != SYNTHETIC), F.lit(False))
    marked = marked.withColumn("__tech", tech)
    out = scan(marked, SECOND + ["__tech", "msg_type"], BY_EVENT, {"tech_number": row_count()})
    return out.withColumn("tech_number", F.when(F.col("__tech"), F.col("tech_number"))).drop("__tech", "double_technical")


def technical_pairs(events: DataFrame) -> DataFrame:
    """One row per (second, n): the n-th technical free throw and the n-th technical foul, either may be missing."""
    numbered = number_technicals(events).where(F.col("tech_number").isNotNull())
    return numbered.groupBy(*SECOND, "tech_number").agg(
        F.min(F.when(F.col("msg_type") == FREE_THROW, F.col("number_event"))).alias("number_event_ft"),
        F.min(F.when(F.col("msg_type") != FREE_THROW, F.col("number_event"))).alias("number_event_foul"))


def with_link_roles(events: DataFrame) -> DataFrame:
    """Which family a free throw or foul belongs to, and the team (and player) it is linked on."""
    is_ft, is_foul = F.col("msg_type") == FREE_THROW, F.col("msg_type") == FOUL
    special_ft, special_foul = type_act(3, FREE_FLAGRANT_OR_CLEAR), type_act(6, FLAGRANT_OR_CLEAR_FOULS)
    text = F.col("description")
    ordinary = ~text.rlike(TECHNICAL_TEXT)
    family = (F.when(special_ft | special_foul, "flagrant")
              .when(ordinary & (is_ft | (is_foul & text.contains(FREE_THROW_TEXT))), "regular"))
    return events.withColumns({
        "link_family": family,
        "link_team": F.when(is_ft, F.col("slug_team")).when(is_foul, opponent(F.col("slug_team"))),
        "link_player": F.when(is_ft, F.col("player1")).when(is_foul, F.col("player3"))})


def match_free_throws(events: DataFrame) -> DataFrame:
    """Meet fouls and free throws of a link group, first on the fouled player, then on the team alone.

    Free throws see how many fouls match and the first of them; fouls see the totals of the free throws they caused.
    """
    roles = with_link_roles(events)
    is_foul = F.col("msg_type") == FOUL
    foul, count = F.when(is_foul, F.col("number_event")), F.when(is_foul, 1).otherwise(0)
    regular_ft = (F.col("msg_type") == FREE_THROW) & (F.col("link_family") == "regular")
    flagrant_ft = (F.col("msg_type") == FREE_THROW) & (F.col("link_family") == "flagrant")
    out = scan(roles, SECOND + ["link_family", "link_team", "link_player"], BY_EVENT, {
        "n_fouls_exact": group_sum(count), "foul_exact": group_min(foul), **_free_throw_totals("player", regular_ft)})
    unmatched = (regular_ft & (F.col("n_fouls_exact") == 0)) | flagrant_ft
    return scan(out, SECOND + ["link_family", "link_team"], BY_EVENT, {
        "n_fouls_team": group_sum(count), "foul_team": group_min(foul), **_free_throw_totals("team", unmatched)})


def flagrant_pairs(events: DataFrame) -> DataFrame:
    """Flagrant and clear-path free throws with the number of opposing fouls of the second and the first of them."""
    matched = match_free_throws(events)
    return matched.where((F.col("link_family") == "flagrant") & (F.col("msg_type") == FREE_THROW)).select(
        *SECOND, F.col("number_event").alias("number_event_ft"), "slug_team",
        F.col("foul_team").alias("number_event_foul"), F.col("n_fouls_team").alias("n_fouls"))


def regular_foul_pairs(events: DataFrame) -> DataFrame:
    """Ordinary free throws with their foul: by fouled player, else by team; ``n_fouls`` counts all that match."""
    exact = F.col("n_fouls_exact") > 0
    matched = match_free_throws(events)
    return matched.where((F.col("link_family") == "regular") & (F.col("msg_type") == FREE_THROW)).select(
        *SECOND, F.col("number_event").alias("number_event_ft"), "slug_team", F.col("player1").alias("player_fouled"),
        F.when(exact, F.col("foul_exact")).otherwise(F.col("foul_team")).alias("number_event_foul"),
        F.when(exact, F.col("n_fouls_exact")).otherwise(F.col("n_fouls_team")).alias("n_fouls"),
        F.when(exact, "player").when(F.col("n_fouls_team") > 0, "team").alias("matched_on"))


def _free_throw_totals(tag: str, counted: Column) -> dict:
    """Group sums of the counted free throws; the points are tracked with a count of unknown ones."""
    home, away = F.col("slug_team") == F.col("team_home"), F.col("slug_team") == F.col("team_away")
    def total(value: Column):
        return group_sum(F.when(counted, value).otherwise(0))
    points = F.coalesce("shot_pts", F.lit(0))
    return {
        f"__{tag}_total_fta": total(F.lit(1)),
        f"__{tag}_unknown": total(F.when(F.col("shot_pts").isNull() | F.col("slug_team").isNull(), 1).otherwise(0)),
        f"__{tag}_shot_pts_home": total(F.when(home, points).otherwise(0)),
        f"__{tag}_shot_pts_away": total(F.when(away, points).otherwise(0)),
        f"__{tag}_poss_home": total(F.when(home, F.col("possession")).otherwise(0)),
        f"__{tag}_poss_away": total(F.when(away, F.col("possession")).otherwise(0))}


def with_foul_totals(events: DataFrame) -> DataFrame:
    """On every foul that caused free throws: ``foul_fta`` and the points and possessions of both teams, else NULL."""
    is_ft, is_foul = F.col("msg_type") == FREE_THROW, F.col("msg_type") == FOUL
    out = match_free_throws(number_technicals(events))
    regular, flagrant = F.col("link_family") == "regular", F.col("link_family") == "flagrant"
    out = scan(out, SECOND + ["tech_number"], BY_EVENT, {
        **_free_throw_totals("tech", is_ft & F.col("tech_number").isNotNull()),
        "__first_tech": group_min(F.when(~is_ft, F.col("number_event")))})
    linked = F.coalesce(is_foul & (regular | flagrant), F.lit(False))
    tech = F.coalesce(F.col("tech_number").isNotNull() & (F.col("__first_tech") == F.col("number_event")), F.lit(False))

    def combined(name: str) -> Column:
        return (F.when(linked, F.col(f"__player_{name}") + F.col(f"__team_{name}")).otherwise(0)
                + F.when(tech, F.col(f"__tech_{name}")).otherwise(0))
    unknown = combined("unknown") > 0
    found = combined("total_fta") > 0
    columns = {"foul_total_fta": F.when(found, combined("total_fta"))}
    for name in TOTALS[1:]:
        value = F.when(found, combined(name))
        columns[f"foul_{name}"] = F.when(~unknown, value) if name.startswith("shot") else value
    return out.withColumns(columns).select(*events.columns, *columns)


def foul_stats(events: DataFrame) -> DataFrame:
    """One row per foul with free throws."""
    return with_foul_totals(events).where(F.col("foul_total_fta").isNotNull()).select(
        "game_id", "number_event", *[F.col(f"foul_{name}").alias(name) for name in TOTALS])


def with_points_and_possessions(events: DataFrame) -> DataFrame:
    """Final points and possessions of both teams per event, and seconds until the next event of the period."""
    out = with_foul_totals(events)
    columns = {}
    for side in ("home", "away"):
        own = F.col("slug_team") == F.col(f"team_{side}")
        columns[f"shot_pts_{side}"] = F.coalesce(
            f"foul_shot_pts_{side}", ifelse_na((F.col("msg_type") == 1) & own, F.col("shot_pts"), F.lit(0)))
        columns[f"poss_{side}"] = F.coalesce(
            f"foul_poss_{side}", ifelse_na((F.col("msg_type") != FREE_THROW) & (F.col("possession") == 1) & own,
                                           F.col("possession"), F.lit(0)))
    out = scan(out, PERIOD, BY_EVENT, {"__next_secs": following(F.col("secs_passed_game"))})
    columns["secs_played"] = F.coalesce(F.col("__next_secs") - F.col("secs_passed_game"), F.lit(0.0))
    return out.withColumns(columns).select(*events.columns, *columns)
