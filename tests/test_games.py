"""Hand-written mini games for rules that are rare in the given tables."""
import pytest
from pyspark.sql import functions as F

from stintflow.operators.scan import order_chunk, split_large_groups
from stintflow.plans import events, fouls, garbage, lineups, possessions, stats

from .conftest import rows

SCHEMA = ("game_id INT, period INT, number_event BIGINT, clock STRING, secs_passed_game DOUBLE, msg_type INT, act_type INT, slug_team STRING, "
          "off_slug_team STRING, player1 STRING, player2 STRING, player3 STRING, description STRING, desc_value INT, shot_pts INT, hs BIGINT, vs BIGINT")


def game(spark, *specs, game_id=1):
    """Events in order; a spec gives what matters, e.g. ``dict(t=1, s=30, team="H")``."""
    data = []
    for n, e in enumerate(specs, 1):
        period, secs = e.get("p", 1), float(e.get("s", 0))
        left = (period * 600 if period <= 4 else 2400 + (period - 4) * 300) - secs
        team = e.get("team")
        data.append((game_id, period, n, f"{int(left // 60):02d}:{left % 60:04.1f}", secs, e["t"], e.get("a", 0), team, e.get("off", team),
                     e.get("p1"), e.get("p2"), e.get("p3"), e.get("d", ""), e.get("v"), e.get("pts", 0), e.get("hs", 0), e.get("vs", 0)))
    return spark.createDataFrame(data, SCHEMA).withColumns(
        {"team_home": F.lit("H"), "team_away": F.lit("A"), "number_original": F.col("number_event")})


@pytest.fixture(params=[None, 2], ids=["whole", "split"])
def run(request):
    """Run a step on the whole game, and on the game cut into pieces of two events."""
    def apply(df, step, *args):
        if request.param is None:
            return step(df, *args)
        log = split_large_groups(df, ["game_id"], order_chunk(number="number_event", rows=request.param), request.param)
        return log.apply(step, *args).frame()
    return apply


LOGS = "game_id INT, player_id INT, player_name STRING, team_abbreviation STRING, team_location STRING, team_id INT"


def logs(spark):
    data = [(1, i + 10 * (t == "A"), f"{t.lower()}{i}", t, "home" if t == "H" else "away", 1 if t == "H" else 2) for t in "HA" for i in range(1, 9)]
    return spark.createDataFrame(data, LOGS)


def test_replays_are_dropped_before_numbering(spark):
    feed = spark.createDataFrame(
        [(1, 1, "10:00", 5, 12, 0), (1, 1, "09:50", 9, 18, 0), (1, 1, "09:50", 7, 1, 0), (1, 1, "09:58", 8, 2, 0)],
        "game_id INT, period INT, clock STRING, number_event INT, msg_type INT, act_type INT").withColumns(
        {"slug_team": F.lit("H"), "off_slug_team": F.lit("H"), "description": F.when(F.col("msg_type") == 2, "Missed shot").otherwise("x"), "desc_value": F.lit(2)})
    for max_rows in (20_000, 2):
        out = events.sequence_events(feed, logs(spark), max_rows).frame()
        assert rows(out, "number_event", "number_original", "hs", "vs") == [(1, 5, 0, 0), (2, 8, 0, 0), (3, 7, 2, 0)]


def test_points_need_a_scoring_type_and_no_miss(spark):
    df = game(spark, dict(t=1, v=3, d="Made"), dict(t=2, v=2, d="Missed"), dict(t=3, v=1, d="Missed Free Throw"), dict(t=4, v=1, d="Rebound")).drop("shot_pts")
    assert rows(events.with_points(df), "number_event", "shot_pts") == [(1, 3), (2, 0), (3, 0), (4, 0)]


STARTS = [dict(t=12), dict(t=1, s=10, team="H", p1="h1"), dict(t=1, s=15, team="H", p1="h2"), dict(t=8, s=20, team="H", p1="h3", p2="h6"),
          dict(t=8, s=40, team="H", p1="h6", p2="h3"), dict(t=6, s=50, a=11, team="H", p1="h7"), dict(t=9, s=55, team="H", p1="h8"),
          dict(t=2, s=60, team="H", p1="h4", p3="0"), dict(t=13, s=600)]


def test_starters(spark):
    df = game(spark, *STARTS)
    assert rows(lineups.players_subbed(df, logs(spark)), "player_name", "in_out", "starter", "player_id") == [("h3", "out", 1, 3), ("h6", "in", 0, 6)]
    found = lineups.period_starters(df, logs(spark))
    assert rows(found, "player_name") == [("h1",), ("h2",), ("h3",), ("h4",)]
    assert rows(lineups.starters_missing(found), "slug_team", "n") == [("H", 4)]
    box = spark.createDataFrame(
        [(1, 1, 5, "h5", "H", "10:00", 0), (1, 1, 8, "h8", "H", "09:00", 0), (1, 1, 7, "h7", "H", "10:00", 1), (1, 1, 11, "a1", "A", "10:00", 0)],
        "game_id INT, period INT, player_id INT, player_name STRING, team_abbreviation STRING, min STRING, fga INT").withColumns(
        {c: F.lit(0) for c in ("fta", "reb", "ast", "stl", "blk", "turnovers", "pf")})
    assert rows(lineups.starters_repair(found, box), "player_name", "slug_team") == [("h5", "H")]
    assert rows(lineups.starting_lineups(lineups.all_starters(df, logs(spark), box), logs(spark)), "lineup_start", "team_location") == [
        ("h1, h2, h3, h4, h5", "home")]


def test_overtime_repair_needs_five_minutes(spark):
    df = game(spark, dict(t=1, p=5, s=2410, team="H", p1="h1"))
    found = lineups.period_starters(df, logs(spark))
    box = spark.createDataFrame([(1, 5, 2, "h2", "H", "5:00", 0), (1, 5, 3, "h3", "H", "10:00", 0)],
                                "game_id INT, period INT, player_id INT, player_name STRING, team_abbreviation STRING, min STRING, fga INT").withColumns(
        {c: F.lit(0) for c in ("fta", "reb", "ast", "stl", "blk", "turnovers", "pf")})
    assert rows(lineups.starters_repair(found, box), "player_name") == [("h2",)]


def test_lineups_follow_substitutions(spark, run):
    df = game(spark, dict(t=2, s=1, team="A", p1="a1"), *STARTS)
    starts = lineups.starting_lineups(lineups.period_starters(df, logs(spark)), logs(spark))
    got = rows(run(df, lineups.lineups_on_events, starts), "number_event", "lineup_home", "lineup_away")
    first, changed = "h1, h2, h3, h4", "h1, h2, h4, h6"
    # Before the period-start row there is no earlier line-up, so the next known one is taken.
    assert got == sorted([(n, changed if n == 5 else first, "a1") for n in range(1, 11)], key=repr)


def test_unknown_lineup_stays_unknown(spark, run):
    df = game(spark, dict(t=8, s=20, team="A", p1="a1", p2="a2"), dict(t=1, s=30, team="A", p1="a1"))
    starts = spark.createDataFrame([(1, 1, "H", "h1", "home")], "game_id INT, period INT, slug_team STRING, lineup_start STRING, team_location STRING")
    assert rows(run(df, lineups.lineups_on_events, starts), "number_event", "lineup_away") == [(1, None), (2, None)]


LANE = [dict(t=3, s=30, a=10, team="H"), dict(t=6, s=30, a=2, team="A"), dict(t=7, s=30, a=3, team="A"), dict(t=3, s=31, a=10, team="H")]


@pytest.mark.parametrize("extra, expected", [([], [1]), ([dict(t=1, s=30, team="H")], [])])
def test_lane_violation(spark, run, extra, expected):
    out = run(possessions.possession_flag(game(spark, *LANE, *extra)), possessions.mark_lane_violations)
    assert [n for n, hit in rows(out, "number_event", "lane_violation") if hit] == expected


JUMP = [dict(t=1, s=10, team="A"), dict(t=9, s=20, team="H"), dict(t=10, s=20, a=1, team="H"), dict(t=2, s=40, team="A")]


@pytest.mark.parametrize("change, hit", [({}, True), ({1: dict(t=9, s=20, team="A")}, False), ({3: dict(t=2, s=40, team="H")}, False),
                                         ({0: dict(t=1, s=10, team="A"), 1: dict(t=9, s=20, team="H"), "add": dict(t=4, s=20, team="H")}, False)])
def test_jumpball_turnover(spark, run, change, hit):
    specs = [change.get(i, e) for i, e in enumerate(JUMP)] + ([change["add"]] if "add" in change else [])
    marked = run(possessions.possession_flag(game(spark, *specs)), possessions.mark_jumpball_turnovers)
    assert [n for n, m in rows(marked, "number_event", "jumpball_turnover") if m] == ([3] if hit else [])
    if hit:
        moved = possessions.apply_marks(marked.withColumn("lane_violation", F.lit(False)))
        assert rows(moved.where("jumpball_turnover"), "possession", "slug_team", "off_slug_team") == [(1, "A", "A")]


def test_consecutive_possessions(spark, run):
    df = game(spark, dict(t=2, team="H"), dict(t=4, team="A"), dict(t=5, team="H"), dict(t=1, team="A"), dict(t=6, a=30, team="A", off="H"),
              dict(t=1, team="H"), dict(t=1, p=2, s=600, team="H"))
    out = run(df, possessions.corrected_possessions)
    # The first H row is followed by another H possession; the foul row is not a possession, so event 4 and 6 stay.
    assert rows(out.where("possession = 1"), "number_event") == [(3,), (4,), (6,), (7,)]


def test_possession_start(spark, run):
    df = game(spark, dict(t=12), dict(t=1, s=10, team="H", pts=2), dict(t=2, s=20, team="A"), dict(t=4, s=21, team="H", v=0),
              dict(t=1, s=30, team="H", pts=2), dict(t=6, s=30, team="A"), dict(t=3, s=30, a=10, team="H", pts=1), dict(t=5, s=40, team="A"),
              dict(t=6, s=50, a=6, team="H"), dict(t=3, s=50, a=10, team="A", pts=1), dict(t=2, s=60, team="A"))
    flagged = possessions.possession_flag(df)
    got = dict(rows(run(flagged, possessions.with_possession_start), "number_event", "start_poss"))
    assert got[2] == "10:00.0" and got[3] == "09:50.0"      # after the made shot
    assert got[4] == "09:39.0"                              # defensive rebound, on its own row
    assert got[6] == got[7] == "09:39.0"                    # the and-one starts nothing
    assert got[8] == "09:39.0" and got[9] == "09:20.0"      # the turnover starts one on the next row
    assert got[11] == "09:20.0"                             # free throw right after a (6,6) foul starts nothing


def test_possession_start_earlier_event_wins(spark, run):
    df = game(spark, dict(t=12), dict(t=1, s=10, team="H", pts=2), dict(t=4, s=12, team="A", v=0))
    got = dict(rows(run(possessions.possession_flag(df), possessions.with_possession_start), "number_event", "start_poss"))
    assert got[3] == "09:50.0"


def last_of(spark, run, last):
    df = game(spark, dict(t=12), dict(t=5, s=10, team="A"), last, dict(t=13, s=600, hs=7)).withColumns({"possession": F.lit(0), "start_poss": F.lit("10:00.0")})
    out = run(df, possessions.with_last_possessions)
    assert rows(out.where("msg_type <> 99"), "number_event") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    return rows(out.where("msg_type = 99"), "number_event", "slug_team", "off_slug_team", "possession", "start_poss", "hs", "number_original")


@pytest.mark.parametrize("last, team", [(dict(t=1, s=590, team="H"), "A"), (dict(t=4, s=590, team="H", v=0), "H"), (dict(t=3, s=590, a=12, team="H"), "A")])
def test_last_possession(spark, run, last, team):
    assert last_of(spark, run, last) == [(3.5, team, team, 1, "00:10.0", 7, 0)]


def test_flagrant_free_throws_do_not_count_as_last_event(spark, run):
    assert last_of(spark, run, dict(t=3, s=590, a=26, team="A")) == [(3.5, "H", "H", 1, "09:50.0", 7, 0)]


@pytest.mark.parametrize("last", [dict(t=1, s=600, team="H"), dict(t=4, s=590, team="H", v=1)])
def test_no_last_possession(spark, run, last):
    assert last_of(spark, run, last) == []


def test_double_technicals_ignore_timeouts(spark, run):
    df = game(spark, dict(t=6, s=5, a=11, team="H", d="Technical foul"), dict(t=9, s=5, team="H"), dict(t=6, s=5, a=11, team="A", d="Technical foul"),
              dict(t=6, s=9, a=11, team="H", d="Technical foul"), dict(t=6, s=9, a=11, team="H", d="Technical foul"))
    got = rows(run(df, fouls.mark_double_technicals).withColumn("text", fouls.double_technical_text()), "number_event", "text")
    assert [n for n, text in got if text == "Double Technical foul"] == [1, 3]


FOULS = [
    dict(t=6, s=5, a=11, team="H", d="Technical foul"), dict(t=3, s=5, a=16, team="A", d="Free Throw Technical", pts=1),
    dict(t=6, s=5, a=17, team="H", d="Defense 3 Second"), dict(t=3, s=5, a=16, team="A", d="Missed Free Throw Technical"),
    dict(t=6, s=20, a=14, team="A", d="Flagrant"), dict(t=3, s=20, a=18, team="H", d="Free Throw", pts=1), dict(t=3, s=20, a=19, team="H", d="Free Throw", pts=1),
    dict(t=6, s=30, a=2, team="A", p1="a1", p3="h1", d="Shooting (2 FT)"), dict(t=6, s=30, a=2, team="A", p1="a2", p3="h2", d="Shooting (2 FT)"),
    dict(t=3, s=30, a=11, team="H", p1="h1", d="Free Throw", pts=1), dict(t=3, s=30, a=12, team="H", p1="h1", d="Free Throw", pts=1),
    dict(t=3, s=30, a=10, team="H", p1="h9", d="Free Throw", pts=1), dict(t=6, s=40, a=1, team="A", p3="h1", d="Personal"),
    dict(t=3, s=40, a=10, team="H", p1="h1", d="Free Throw", pts=1)]


def test_free_throws_go_to_their_foul(spark, run):
    df = possessions.possession_flag(game(spark, *FOULS))
    got = rows(run(df, fouls.foul_stats), "number_event", "total_fta", "shot_pts_home", "shot_pts_away", "poss_home", "poss_away")
    assert got == [(1, 1, 0, 1, 0, 0), (3, 1, 0, 0, 0, 0), (5, 2, 2, 0, 0, 0),
                   # Two free throws of the fouled player, and one of a player without a foul counted for both fouls of the team.
                   (8, 3, 3, 0, 1, 0), (9, 1, 1, 0, 0, 0)]
    pairs = rows(run(df, fouls.regular_foul_pairs), "number_event_ft", "number_event_foul", "n_fouls", "matched_on")
    assert pairs == [(10, 8, 1, "player"), (11, 8, 1, "player"), (12, 8, 2, "team"), (14, None, 0, None)]
    assert rows(run(df, fouls.flagrant_pairs), "number_event_ft", "number_event_foul", "n_fouls") == [(6, 5, 1), (7, 5, 1)]
    assert rows(fouls.technical_pairs(df), "tech_number", "number_event_ft", "number_event_foul") == [(1, 2, 1), (2, 4, 3)]


def test_points_of_made_shots_and_seconds(spark, run):
    df = possessions.possession_flag(game(spark, dict(t=1, s=10, team="H", pts=3), dict(t=5, s=30, team="A"), dict(t=1, p=2, s=700, team="A", pts=2)))
    got = rows(run(df, fouls.with_points_and_possessions), "number_event", "shot_pts_home", "shot_pts_away", "poss_home", "poss_away", "secs_played")
    assert got == [(1, 3, 0, 1, 0, 20.0), (2, 0, 0, 0, 1, 0.0), (3, 0, 2, 0, 1, 0.0)]


def garbage_game(spark, *specs):
    starts = spark.createDataFrame([(1, 1, "H", "h1, h2", "home"), (1, 1, "A", "a1, a2", "away")],
                                   "game_id INT, period INT, slug_team STRING, lineup_start STRING, team_location STRING")
    return game(spark, *specs).withColumns({"lineup_home": F.lit("h1, h5"), "lineup_away": F.lit("a1, a6")}), starts


@pytest.mark.parametrize("secs, margin, flag", [(1799, 40, 0), (1800, 25, 1), (1949, 24, 0), (1950, 20, 1), (2099, 19, 0), (2100, 10, 1), (2399, 9, 0)])
def test_garbage_time_bands(spark, run, secs, margin, flag):
    df, starts = garbage_game(spark, dict(t=2, p=4 if secs >= 1800 else 3, s=secs, team="H", hs=margin))
    assert rows(run(df, garbage.with_garbage_time, starts), "garbage_time") == [(flag,)]


def test_garbage_time_uses_the_margin_before_and_is_undone(spark, run):
    df, starts = garbage_game(spark, dict(t=1, p=4, s=2200, team="H", hs=11, pts=2), dict(t=2, p=4, s=2210, team="A", hs=11),
                              dict(t=1, p=4, s=2300, team="A", hs=11, vs=3, pts=3), dict(t=2, p=4, s=2310, team="A", hs=11, vs=3),
                              dict(t=2, p=4, s=2320, team="A", hs=20, vs=3))
    got = rows(run(df, garbage.with_garbage_time, starts), "number_event", "margin_before", "garbage_time")
    assert got == [(1, 9, 0), (2, 11, 0), (3, 11, 0), (4, 8, 0), (5, 17, 1)]


def test_garbage_time_needs_benches(spark, run):
    df, starts = garbage_game(spark, dict(t=2, p=4, s=2200, team="H", hs=30))
    df = df.withColumn("lineup_home", F.lit("h1, h2"))
    assert rows(run(df, garbage.with_garbage_time, starts), "total_starters_home", "total_starters_away", "garbage_time") == [(2, 1, 0)]


def test_roles_have_five_slots(spark):
    df = game(spark, dict(t=1, team="A"), dict(t=12)).withColumns({"lineup_home": F.lit("h1, h2"), "lineup_away": F.lit("a1, a2, a3, a4, a5, a6")})
    got = rows(garbage.with_off_def_lineups(df), "number_event", "def_slug_team", "off_player1", "off_player5", "def_player2", "def_player3")
    assert got == [(1, "H", "a1", "a5", "h2", None), (2, None, None, None, None, None)]


def test_stints(spark, run):
    df = game(spark, dict(t=1, team="H"), dict(t=8, team="H"), dict(t=12), dict(t=8, team="A"), dict(t=1, team="A"), dict(t=8, team="H"))
    got = rows(run(df, stats.with_stints), "number_event", "stint_home", "stint_away")
    # A row of the other team takes the next own value, and after the last own row the previous one.
    assert got == [(1, 1, 2), (2, 2, 2), (3, 3, 2), (4, 3, 2), (5, 3, 2), (6, 3, 2)]
