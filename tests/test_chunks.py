"""Large groups in chunks: few of them, places uncut, and only summaries travel. The steps of a build beyond the default number of tasks."""
from pyspark.sql import functions as F

from stintflow import fixtures as fx
from stintflow.operators import scan as scans
from stintflow.operators.scan import CHUNK, CUT, EventLog, group_last, group_max, group_sum, order_chunk, previous, row_count, running_sum, scan, split_large_groups
from stintflow.plans import events as ev, season, stats

from .conftest import rows
from .test_placement import exchanges, no_broadcast  # noqa: F401  a fixture


def test_chunks_follow_the_rows_of_a_game(spark, small):
    log = ev.sequence_events(fx.feed(spark, small), fx.player_logs(spark, small), 60)
    part = log.parts[1]
    games = part.groupBy("game_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(CHUNK).alias("chunks")).collect()
    assert games and all(game.chunks <= game.n // 60 + 2 for game in games)
    places = part.where(~F.col(CUT)).groupBy("game_id", "secs_passed_game").agg(F.countDistinct(CHUNK).alias("chunks"))
    assert places.where("chunks > 1").isEmpty()


def test_scans_of_chunks_move_no_events(spark, small, no_broadcast):  # noqa: F811
    log = ev.sequence_events(fx.feed(spark, small), fx.player_logs(spark, small), 60).stored_by("game_id")
    part = log.parts[1]
    assert CHUNK in part.columns
    counted = scan(part, ["game_id", "slug_team"], ["number_event"], {"nth": row_count()})
    assert max(exchanges(counted, "act_type")) == 0


def test_crowded_places_are_cut_and_still_one_group(spark):
    """Second 1 has 40 rows of two teams, some without a team; it is cut, the other seconds are not."""
    values = [(g, s, n, None if n % 5 == 0 else n % 2) for g in (None, 1, 2) for n in range(60) for s in [1.0 if 10 <= n < 50 else n // 4 / 100 if n < 10 else float(n)]]
    df = spark.createDataFrame(values, "g INT, s DOUBLE, n INT, team INT")
    log = split_large_groups(df, ["g"], order_chunk("s", number="n", rows=8), 8)
    assert [r.s for r in log.parts[1].where(CUT).select("s").distinct().collect()] == [1.0]
    steps = {"nth": row_count(), "total": running_sum(F.col("n")), "sum": group_sum(F.col("n")), "most": group_max(F.col("n")),
             "last": group_last(F.when(F.col("n") % 3 == 0, F.col("n"))), "before": previous(F.col("n"))}
    for keys in (["g", "s", "team"], ["g", "s"], ["g", "team"]):
        cut = log.apply(scan, keys, ["n"], steps).frame()
        assert rows(cut) == rows(EventLog((df,)).apply(scan, keys, ["n"], steps).frame())


def test_more_tasks_than_shuffle_partitions_need_no_exchange(spark, small, no_broadcast, monkeypatch):  # noqa: F811
    monkeypatch.setattr(scans, "ROWS_PER_TASK", 150)
    tables = fx.landed(spark, small)
    log = season.enriched_events(tables)
    assert log.tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert exchanges(log.frame(), "act_type") == [0]
    log = log.stored_by("game_id")
    existing = season.existing_stats(log)
    members = stats.lineup_members(existing, tables.player_logs, stats.lineup_index(existing))
    assert exchanges(log.apply(stats.attach_lineup_ids, members, log.tasks).frame(), "act_type") == [0]


def test_lineup_tables_without_play_by_play(spark, small):
    tables = fx.landed(spark, small)
    whole, part = season.build_season(tables), season.build_season(tables, play_by_play=False)
    assert part.play_by_play is None
    for name in ("lineup_index", "lineup_stats", "lineup_stats_existing"):
        assert rows(getattr(part, name)) == rows(getattr(whole, name))
    # What follows from one row is no longer stored with the events, but is there.
    assert {"off_lineup", "def_player5", "off_player5_id"} <= set(whole.play_by_play.columns)


def test_ids_are_dense_in_every_season(spark, small):
    index = season.build_season(fx.landed(spark, small), play_by_play=False).lineup_index
    for found in index.groupBy("season").agg(F.count("lineup_id").alias("n"), F.max("lineup_id").alias("m"), F.countDistinct("lineup_id").alias("d")).collect():
        assert found.n == found.m == found.d


def test_scans_of_chunks_write_carried_values_only(spark, small, monkeypatch):
    """No scan writes the rows again; inside uncut places there is nothing to carry."""
    part = ev.sequence_events(fx.feed(spark, small), fx.player_logs(spark, small), 60).stored_by("game_id").parts[1]
    stored, staged, stage = [], [], scans.stage
    monkeypatch.setattr(scans, "stage_by", lambda df, *args: stored.append(df.columns))
    monkeypatch.setattr(scans, "stage", lambda df: (staged.append(df), stage(df))[1])
    rows_of = part.count()
    inside = scan(part, ["game_id", "secs_passed_game"], ["number_event"], {"__n": row_count()})
    assert not staged and inside.agg(F.count("__n")).first()[0] == rows_of
    along = scan(part, ["game_id"], ["number_event"], {"__n": row_count()})
    assert along.where(F.col("__n") != F.col("number_event")).isEmpty()
    assert not stored and len(staged) == 1 and staged[0].count() < rows_of / 8
    assert not set(staged[0].columns) & set(part.columns)


def test_large_games_are_stored_without_columns_that_only_the_play_by_play_needs(spark, small, monkeypatch):
    stored, stage_by = [], scans.stage_by
    monkeypatch.setattr(scans, "stage_by", lambda df, *args: (stored.append(df.columns), stage_by(df, *args))[1])
    season.build_season(fx.landed(spark, small), 60, play_by_play=False)
    last = next(columns for columns in reversed(stored) if "stint_home" in columns)
    assert not {"clock", "player1", "act_type"} & set(last) and "shot_pts_home" in last
    assert sum(CHUNK in columns for columns in stored) <= 5
