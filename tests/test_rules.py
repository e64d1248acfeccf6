"""NULL, order and text rules of the expression helpers and verbs."""
import pytest
from pyspark.sql import functions as F

from stintflow import functions as fn
from stintflow.operators import verbs

from .conftest import rows


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_choice_on_unknown_is_unknown(spark):
    unknown = F.lit(None).cast("boolean")
    assert one(spark, fn.ifelse_na(unknown, F.lit(1), F.lit(2)), fn.ifelse_na(F.lit(False), F.lit(1), F.lit(2))) == (None, 2)


def test_not_in_keeps_unknown(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x STRING")
    assert rows(df.where(fn.not_in(F.col("x"), ["a"]))) == sorted([("b",), (None,)], key=repr)


def test_sum_na(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 5)], "g INT, v INT")
    got = rows(df.groupBy("g").agg(fn.sum_na(F.col("v")).alias("s")), "g", "s")
    assert got == [(1, None), (2, 5)]


def test_text_helpers(spark):
    text = F.lit("Technical foul\nTechnical")
    assert one(spark, fn.replace_first(text, "Technical", "Double Technical"), fn.extract_first(F.lit("schedule_2007_2.csv"), r"\d+"),
               fn.extract_first(F.lit("none"), r"\d+")) == ("Double Technical foul\nTechnical", "2007", None)


@pytest.mark.parametrize("name, expected", [("GAME_ID", "game_id"), ("locX", "loc_x"), ("FG%", "fg_percent"), ("Retail Price ($)", "retail_price"),
                                            ("PLAYER1_ID", "player1_id"), ("2P", "x2p"), ("FG3M", "fg3m"), ("FG3_PCT", "fg3_pct")])
def test_snake_case(name, expected):
    assert fn.snake_case(name) == expected


def test_clean_names_numbers_repeats(spark):
    assert verbs.clean_names(spark.range(1).toDF("locX").select("locX", F.lit(1).alias("loc x"))).columns == ["loc_x", "loc_x_2"]


@pytest.mark.parametrize("period, clock, passed", [(1, "10:00", 0), (1, "09:59.5", 0.5), (4, "00:00.0", 2400), (5, "05:00", 2400), (5, "00:30.0", 2670),
                                                   (6, "05:00", 2700), (7, "02:00", 3180), (1, "bad", None), (1, None, None)])
def test_game_clock(spark, period, clock, passed):
    assert one(spark, fn.seconds_passed_game(F.lit(period), F.lit(clock).cast("string")))[0] == passed


def test_rows_update_writes_unknown_and_leaves_the_rest(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k INT, x STRING, y INT")
    changes = spark.createDataFrame([(1, None), (3, "z")], "k INT, x STRING")
    assert rows(verbs.rows_update(df, changes, ["k"]), "k", "x", "y") == sorted([(1, None, 1), (2, "b", 2), (3, "z", 3)], key=repr)


def test_rows_update_refuses_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a")], "k INT, x STRING")
    changes = spark.createDataFrame([(1, "b"), (1, "c")], "k INT, x STRING")
    with pytest.raises(Exception, match="duplicate key"):
        verbs.rows_update(df, changes, ["k"]).collect()


def test_fallback_join(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x")], "s INT, p STRING")
    other = spark.createDataFrame([(1, "x", 10), (1, "z", 11), (2, "q", 20)], "s INT, p STRING, foul INT")
    got = rows(verbs.fallback_join(df, other, ["s", "p"], ["s"], "foul"), "s", "p", "foul")
    assert got == sorted([(1, "x", 10), (1, "y", 10), (2, "x", 20), (3, "x", None)], key=repr)


def test_pivot_unpivot_first_last(spark):
    df = spark.createDataFrame([(1, "a", 2, 9), (1, "a", 1, 8), (1, "b", 3, 7)], "k INT, kind STRING, o INT, v INT")
    assert rows(verbs.pivot_first(df, ["k"], "kind", ["v"], ["a", "b", "c"], ["o"]), "k", "v_a", "v_b", "v_c") == [(1, 8, 7, None)]
    assert rows(verbs.first_per_key(df, ["k"], ["o"]), "kind", "o") == [("a", 1)]
    assert rows(verbs.last_per_key(df, ["k"], ["o"]), "kind", "o") == [("b", 3)]
    wide = spark.createDataFrame([(1, 5, None)], "k INT, x_a INT, x_b INT")
    assert rows(verbs.unpivot_columns(wide, ["k"], ["x_a", "x_b"], "name", "v", "x_"), "name", "v") == [("a", 5), ("b", None)]


def test_lookup_never_multiplies_rows(spark):
    dim = spark.createDataFrame([(1, "new"), (1, "old"), (None, "x")], "id INT, name STRING")
    assert rows(verbs.lookup_table(dim, "id", "name", new_key="k", new_value="n"), "k", "n") == [(1, "new")]


def test_null_groups_count_as_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), ("a", 1)], "g string, v int")
    assert rows(verbs.group_filter(df, ["g"], F.max("v") > 4), "g", "v") == [(None, 1), (None, 5)]
    assert rows(verbs.attach_aggregates(df, ["g"], {"n": F.count("*")}), "g", "v", "n") == [("a", 1, 1), (None, 1, 2), (None, 5, 2)]


def test_prefix_is_cut_only_where_it_is(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, l_tax int, other int")
    assert rows(verbs.unpivot_columns(df, ["id"], ["l_tax", "other"], "name", "value", "l_"), "name", "value") == [("other", 3), ("tax", 2)]


def test_whole_numbers_are_cut_off(spark):
    df = spark.createDataFrame([("10.7",), ("401.0",), ("-3.9",), ("x",), ("99999999999",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.whole_number(F.col("t"))).collect()] == [10, 401, -3, None, None, None]


def test_names_are_those_of_the_season(spark):
    from stintflow.plans.events import attach_names, season_of
    logs = spark.createDataFrame([(1, 22005, 7, "Ann", 3, "SAN"), (2, 22018, 7, "Ann B", 3, "LVA")],
                                 "game_id int, season_id int, player_id int, player_name string, team_id int, team_abbreviation string")
    feed = spark.createDataFrame([(1, 1, 7, 3), (2, 1, 7, 3)], "game_id int, number_event int, player1_id int, team_id int") \
        .selectExpr("*", "CAST(NULL AS INT) AS player2_id", "CAST(NULL AS INT) AS player3_id", "team_id AS off_team_id")
    assert rows(attach_names(feed, logs), "game_id", "player1", "slug_team") == [(1, "Ann", "SAN"), (2, "Ann B", "LVA")]
    assert sorted(r[0] for r in logs.select(season_of("season_id")).collect()) == [2005, 2018]
