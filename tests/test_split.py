"""Large groups are cut into chunks; the results must not depend on where the cuts fall or on the partition count."""
import pytest
from pyspark.sql import functions as F

from stintflow import fixtures as fx
from stintflow.operators.scan import (fill_down, fill_up, following, group_last, group_max, group_min, group_sum, number_rows,
                                      order_chunk, previous, row_count, running_sum, scan, split_large_groups)
from stintflow.plans import season

from .conftest import rows


@pytest.fixture(scope="module")
def whole(spark, small):
    built = season.build_season(fx.landed(spark, small))
    return {name: rows(getattr(built, name)) for name in built._fields}


# One game of the smallest tables has about 80 events: 60 cuts some games, 7 cuts every game into many pieces.
@pytest.mark.parametrize("max_rows", [60, 7])
def test_build_does_not_depend_on_cuts(spark, small, whole, max_rows):
    built = season.build_season(fx.landed(spark, small), max_rows=max_rows)
    for name in built._fields:
        assert rows(getattr(built, name)) == whole[name], name


def test_build_does_not_depend_on_partitions(spark, small, whole):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        built = season.build_season(fx.landed(spark, small))
        assert rows(built.lineup_stats) == whole["lineup_stats"]
        assert rows(built.play_by_play) == whole["play_by_play"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_substitution_sequences_are_folded_in_pieces(spark, small, monkeypatch):
    from stintflow.plans import events, lineups
    feed, logs = fx.feed(spark, small), fx.player_logs(spark, small)

    def changes(max_rows):
        log = events.sequence_events(feed, logs, max_rows)
        starts = lineups.starting_lineups(lineups.all_starters(log.frame(), logs), logs)
        return rows(log.apply(lineups.lineup_changes, starts).frame())
    expected = changes(20_000)
    monkeypatch.setattr(lineups, "STAY_STEP", 2)
    assert changes(7) == expected


def test_every_step_matches_a_plain_loop(spark):
    values = [(g, n, None if (n * 7 + g) % 3 == 0 else n * g % 5) for g in (1, 2, 3) for n in range(1, 12 * g)]
    df = spark.createDataFrame(values, "g INT, n INT, v INT")
    log = split_large_groups(df, ["g"], order_chunk(number="n", rows=4), 15)
    assert len(log.parts) == 2
    steps = {"total": running_sum(F.coalesce("v", F.lit(0))), "row": row_count(), "down": fill_down(F.col("v")), "up": fill_up(F.col("v")),
             "prev": previous(F.col("v")), "next": following(F.col("v")), "sum": group_sum(F.col("v")), "max": group_max(F.col("v")),
             "min": group_min(F.col("v")), "last": group_last(F.col("v"))}
    got = rows(log.apply(scan, ["g"], ["n"], steps).frame(), "g", "n", *steps)
    expected = []
    for g in (1, 2, 3):
        vs = [v for gg, _, v in values if gg == g]
        known = [v for v in vs if v is not None]
        for i, v in enumerate(vs):
            down = next((x for x in reversed(vs[:i + 1]) if x is not None), None)
            up = next((x for x in vs[i:] if x is not None), None)
            expected.append((g, i + 1, sum(x or 0 for x in vs[:i + 1]), i + 1, down, up, vs[i - 1] if i else None,
                             vs[i + 1] if i + 1 < len(vs) else None, sum(known), max(known), min(known), known[-1]))
    assert got == sorted(expected, key=repr)


def test_null_group_keys_are_one_group(spark):
    df = spark.createDataFrame([(1, None, i) for i in range(1, 10)] + [(1, "a", i) for i in range(10, 20)], "g INT, t STRING, n INT")
    log = split_large_groups(df, ["g"], order_chunk(number="n", rows=3), 5)
    got = rows(log.apply(scan, ["g", "t"], ["n"], {"row": row_count()}).frame(), "n", "row")
    assert got == sorted([(i, i) for i in range(1, 10)] + [(i, i - 9) for i in range(10, 20)], key=repr)


def test_number_rows_over_nested_blocks(spark):
    df = spark.range(1, 400).select((F.col("id") % 2).alias("g"), (F.col("id") * 37 % 401).alias("n"))
    blocks = [("coarse", F.floor(F.col("n") / 50)), ("fine", F.floor(F.col("n") / 7))]
    got = rows(number_rows(df, ["g"], ["n"], blocks, "number"), "g", "n", "number")
    values = sorted((r.g, r.n) for r in df.collect())
    expected = [(g, n, [x for x in values if x[0] == g].index((g, n)) + 1) for g, n in values]
    assert got == sorted(expected, key=repr)
