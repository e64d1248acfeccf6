"""Files in and out: season folders, typed CSV, nested JSON, compaction, publishing."""
import datetime
import json

import pytest
from pyspark.sql import functions as F

from stintflow import fixtures as fx
from stintflow.plans import schedule, season
from stintflow.sources import compact, files, publish
from stintflow.sources.shared import new_path, shared_folder, stage, staging

from .conftest import rows

WHEN = datetime.datetime(2024, 6, 1)


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured is None or shared_folder(spark) == configured


def test_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, 2.5), (2, "x", None)], "a INT, b STRING, c DOUBLE")
    staged = stage(df)
    assert rows(staged) == rows(df) and staged.dtypes == df.dtypes


def test_csv_types_inferred_or_given(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,score\n1,x,2.5\n2,,\n")
    assert files.scan_csv(spark, str(tmp_path)).dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    assert rows(files.scan_csv(spark, str(tmp_path), "id BIGINT, name STRING, score STRING"), "id", "name", "score") == sorted(
        [(1, "x", "2.5"), (2, None, None)], key=repr)


def test_season_files_with_drifting_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id INT, x STRING").write.parquet(str(tmp_path / "schedule_2001"))
    spark.createDataFrame([(2, 5)], "id INT, y INT").write.parquet(str(tmp_path / "schedule_2002"))
    got = files.scan_seasons(spark, str(tmp_path))
    assert rows(got, "id", "x", "y", "season") == sorted([(1, "a", None, 2001), (2, None, 5, 2002)], key=repr)


def test_pluck(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"id": 7, "frames": {"log": [{"a": 1}, {"a": 2}], "other": []}}, indent=2))
    docs = spark.read.option("multiLine", True).json(str(tmp_path))
    assert rows(files.pluck(docs, "frames.log", "id"), "id", "a") == [(7, 1), (7, 2)]


def test_compaction_leaves_the_source_alone(spark, tmp_path):
    source, target = tmp_path / "raw", tmp_path / "compact"
    source.mkdir()
    for n in (11, 12):
        (source / f"{n}.json").write_text(json.dumps({"b": [1, 2], "a": {"n": n}}, indent=4))
    compact.compact_folder(spark, str(source), str(target), files=1)
    back = spark.read.schema("doc_id BIGINT, doc STRING").json(str(target))
    assert rows(back, "doc_id", "doc") == [(11, '{"a":{"n":11},"b":[1,2]}'), (12, '{"a":{"n":12},"b":[1,2]}')]
    assert "\n" in (source / "11.json").read_text()
    assert rows(spark.range(1).select(compact.compact_json(F.lit("{bad")).alias("d"))) == [(None,)]


def test_republish_schedules(spark, tmp_path):
    landed = spark.createDataFrame([("1", "10", 0.0, 2001), ("x", "20", 1.5, 2002)], "id STRING, game_id STRING, status_display_clock DOUBLE, season INT")
    source = str(tmp_path / "landed")
    files.write_parquet(landed, source, "season")
    dataset = publish.datasets()[0]
    paths = publish.republish(spark, dataset, source, str(tmp_path / "out"), updated_at=WHEN)
    back = spark.read.parquet(paths["parquet"])
    assert rows(back, "id", "game_id", "status_display_clock", "season", "_source") == sorted(
        [(1, 10, "0.0", 2001, dataset.title), (None, 20, "1.5", 2002, dataset.title)], key=repr)
    assert files.scan_csv(spark, paths["csv"], "id INT, game_id INT, season INT").count() == 2


def test_rewriting_one_season_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.createDataFrame([(1, 2001), (2, 2002)], "v INT, season INT"), path, "season")
    files.write_parquet(spark.createDataFrame([(9, 2002)], "v INT, season INT"), path, "season")
    assert rows(spark.read.parquet(path), "v", "season") == [(1, 2001), (9, 2002)]


def test_registry_has_twelve_named_datasets():
    names = [d.name for d in publish.datasets()]
    assert len(names) == len(set(names)) == 12


def test_pairing_without_results_and_missing_halves(spark):
    games = spark.createDataFrame([(1, 5, "d", "A @ B", "W", 7), (1, 5, "d", "B vs. A", "L", 6), (1, 6, "d", "C vs. D", "W", 1), (1, 7, "d", "E @ F", "L", 2)],
                                  "SEASON_ID INT, GAME_ID INT, GAME_DATE STRING, MATCHUP STRING, WL STRING, PTS INT")
    paired = schedule.pair_schedule(games)
    assert rows(paired, "GAME_ID", "MATCHUP", "AWAY_WL", "AWAY_PTS", "HOME_WL", "HOME_PTS") == sorted(
        [(5, "A @ B", "W", 7, "L", 6), (7, "E @ F", "L", 2, None, None)], key=repr)
    assert not [c for c in schedule.pair_schedule(games, keep_wl=False).columns if c.endswith("WL")]


def test_season_outputs_hold_the_invariants(spark, small):
    built = season.build_season(fx.landed(spark, small))
    pbp = stage(built.play_by_play)
    assert pbp.groupBy("game_id", "number_event").count().where("count > 1").isEmpty()
    # The score at the end of a game is the sum of its points.
    last = pbp.groupBy("game_id").agg(F.max("hs").alias("hs"), F.max("vs").alias("vs"), *[
        F.sum(F.when((F.col("slug_team") == F.col(team)) & (F.col("msg_type") != 99), F.col("shot_pts"))).alias(name)
        for team, name in (("team_home", "h"), ("team_away", "v"))])
    assert last.where("hs <> coalesce(h, 0) or vs <> coalesce(v, 0)").isEmpty()
    # Seconds of a team add up to the periods played in which its line-up is known.
    ids = built.lineup_index.agg(F.count("lineup_id").alias("n"), F.max("lineup_id").alias("m"), F.countDistinct("lineup_id").alias("d")).first()
    assert ids.n == ids.m == ids.d
    played = built.lineup_stats_existing.groupBy("game_id", "period", "slug_team").agg(F.sum("secs_played").alias("s"))
    assert played.where("s > 600").isEmpty() and not played.where("s = 600").isEmpty()
    paths = publish.write_season_outputs({"lineup_index": built.lineup_index}, new_path(spark, "test"), updated_at=WHEN)
    assert rows(spark.read.parquet(paths["lineup_index"]["parquet"]), "lineup", "lineup_id", "season") == rows(
        built.lineup_index, "lineup", "lineup_id", "season")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_rebuilt_season_leaves_the_others(spark, tmp_path, fmt):
    from stintflow.sources.files import WRITERS
    path = str(tmp_path / "t")
    WRITERS[fmt](spark.createDataFrame([(1, 2001), (2, 2002)], "v int, season int"), path, "season")
    WRITERS[fmt](spark.createDataFrame([(9, 2002)], "v int, season int"), path, "season")
    back = spark.read.format(fmt).option("header", True).schema("v int, season int").load(path)
    assert sorted(map(tuple, back.collect())) == [(1, 2001), (9, 2002)]


def test_season_comes_from_the_file_name_first(spark, tmp_path):
    for place in ("schedules/csv/stats_schedule_2001.csv", "v2/schedule_2005.csv", "v2/schedule.csv", "season=2007/box_1.csv"):
        file = tmp_path / place
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("a\n1\n")
    rows = files.scan_seasons(spark, str(tmp_path), "csv", "a int").collect()
    assert sorted((r.season or 0) for r in rows) == [0, 2001, 2005, 2007]


def test_schedules_are_written_by_season_and_as_master(spark, tmp_path):
    def games(season, number):
        return spark.createDataFrame([(season, number, "d", "A @ B", "W", 7), (season, number, "d", "B vs. A", "L", 6)], "SEASON_ID INT, GAME_ID INT, GAME_DATE STRING, MATCHUP STRING, WL STRING, PTS INT")
    none = games(2001, 1).where("false")
    schedule.write_schedules(schedule.season_schedule(games(2001, 1), none), str(tmp_path))
    paths = schedule.write_schedules(schedule.season_schedule(games(2002, 2), none, season=2002), str(tmp_path))
    for fmt in ("parquet", "master_parquet"):
        assert rows(spark.read.parquet(paths[fmt]), "GAME_ID", "season", "AWAY_PTS", "HOME_PTS") == [(1, 2001, 7, 6), (2, 2002, 7, 6)]
    for fmt in ("csv", "master_csv"):
        assert rows(files.scan_csv(spark, paths[fmt], "GAME_ID INT, season INT") if fmt == "csv" else files.scan_csv(spark, paths[fmt]).select("GAME_ID", "season"), "GAME_ID", "season") == [(1, 2001), (2, 2002)]


def test_publishing_again_copies_only_its_own_seasons(spark, tmp_path):
    folder = str(tmp_path)
    first = spark.createDataFrame([(1, [1, None], 2001), (2, [3], 2002)], "v INT, ids ARRAY<INT>, season INT")
    again = spark.createDataFrame([(9, [4], 2002)], "v INT, ids ARRAY<INT>, season INT")
    publish.write_season_outputs({"t": first}, folder, updated_at=WHEN)
    paths = publish.write_season_outputs({"t": again}, folder, updated_at=WHEN + datetime.timedelta(days=1))["t"]
    assert rows(spark.read.parquet(paths["parquet"]), "v", "season") == [(1, 2001), (9, 2002)]
    assert rows(files.scan_csv(spark, paths["csv"], "v INT, ids STRING, _source STRING, _updated_at TIMESTAMP, season INT"), "v", "ids", "season") == [(1, "1,?", 2001), (9, "4", 2002)]


def test_unknown_order_values_come_last(spark):
    from stintflow.operators import verbs
    df = spark.createDataFrame([(1, None, "n"), (1, 5, "five"), (1, 9, "nine"), (2, None, "only")], "k INT, o INT, v STRING")
    assert rows(verbs.first_per_key(df, ["k"], ["o"]), "k", "v") == [(1, "five"), (2, "only")]
    assert rows(verbs.last_per_key(df, ["k"], ["o"]), "k", "v") == [(1, "n"), (2, "only")]
    assert rows(verbs.pivot_first(df.withColumn("l", F.lit("x")), ["k"], "l", ["v"], ["x"], ["o"]), "k", "v_x") == [(1, "five"), (2, "only")]
    update = spark.createDataFrame([(None, "new")], "k INT, v STRING")
    assert rows(verbs.rows_update(df.withColumn("k", F.expr("nullif(k, 2)")), update, ["k"]), "v") == [("five",), ("n",), ("new",), ("nine",)]


def test_names_of_games_without_a_log(spark):
    from stintflow.plans import events
    logs = spark.createDataFrame([(1, 2023, 10, "Ann", 5, "OLD"), (3, 2024, 10, "Ann", 5, "NEW"), (3, 2024, 11, "Bea", 6, "B")],
                                 "game_id INT, season_id INT, player_id INT, player_name STRING, team_id INT, team_abbreviation STRING")
    feed = spark.createDataFrame([(g, n, 10, 11, None, 5, 6, s) for g, n, s in ((1, 1, None), (2, 1, None), (2, 2, 2023), (3, 1, None))],
                                 "game_id INT, number_event BIGINT, player1_id INT, player2_id INT, player3_id INT, team_id INT, off_team_id INT, season_id INT")
    got = rows(events.attach_names(feed, logs), "game_id", "number_event", "player1", "player2", "slug_team", "off_slug_team")
    # Game 2 has no log: by the season its feed states, or else by names that never changed.
    assert got == [(1, 1, "Ann", None, "OLD", None), (2, 1, "Ann", "Bea", None, "B"), (2, 2, "Ann", None, "OLD", None), (3, 1, "Ann", "Bea", "NEW", "B")]


def test_season_patterns_never_run_over_the_long_path(spark):
    text = str(files.season_from_path())
    assert "file_path" in text and "regexp_extract(_metadata.file_path" not in text


def test_datasets_are_landed_in_one_pass(spark, small, monkeypatch):
    landings, write = [], files.write_parquet
    monkeypatch.setattr(files, "write_parquet", lambda df, *args, **kwargs: (landings.append(args), write(df, *args, **kwargs)))
    from stintflow.workload import QUERIES
    with staging(spark):
        assert QUERIES["republish_dataset"](spark, small).where("season IS NULL").count() == 0
    assert len(landings) == 1
