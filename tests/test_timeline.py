"""Joins on time, ranks, differences, cubes, sessions, sketches and the streamed score against plain loops, with hot keys, ties and NULLs."""
import datetime
import random

import pytest
from pyspark.sql import functions as F

from stintflow.operators import parts, ranking, summaries, temporal
from stintflow.streaming import score

from .conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moments(seed, count):
    pick = random.Random(seed)
    key = lambda: pick.choice(["hot"] * 3 + ["a", "b", None])
    return [(k, key(), pick.choice([None] + [float(n) for n in range(12)])) for k in range(count)]


@pytest.mark.parametrize("tolerance", [None, 2.0])
def test_asof_join(spark, tolerance):
    left, right = moments(1, 150), moments(2, 120)
    got = temporal.asof_join(spark.createDataFrame(left, "id INT, key STRING, at DOUBLE").repartition(5), spark.createDataFrame(right, "rid INT, key STRING, at DOUBLE").repartition(3),
                             ["key"], "at", "at", ["rid"], tolerance=tolerance)
    expected = []
    for k, key, at in left:
        fit = [(t, r) for r, other, t in right if other == key and t is not None and at is not None and t <= at and (tolerance is None or at - t <= tolerance)]
        best = max(fit, default=(None, None))
        expected.append((k, key, at, best[1], best[0]))
    assert rows(got, "id", "key", "at", "last_rid", "last_at") == sorted(expected, key=repr)
    assert temporal.asof_join(spark.createDataFrame([], "id INT, key STRING, at DOUBLE"), spark.createDataFrame(right, "rid INT, key STRING, at DOUBLE"), ["key"], "at", "at", ["rid"]).count() == 0
    alone = temporal.asof_join(spark.createDataFrame(left, "id INT, key STRING, at DOUBLE"), spark.createDataFrame([], "rid INT, key STRING, at DOUBLE"), ["key"], "at", "at", ["rid"])
    assert alone.where("last_rid IS NOT NULL").count() == 0 and alone.count() == 150


def test_a_hot_moment_spreads_over_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        equal = spark.range(4000).select(F.lit("hot").alias("key"), F.lit(1.0).alias("at"))
        sizes = [r["count"] for r in parts.ordered_parts(equal, ["key", "at"]).groupBy(parts.PART).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) > 1 and max(sizes) < 3000 and sum(sizes) == 4000


@pytest.mark.parametrize("width, crowd", [(1.0, 20_000), (4.0, 3), (100.0, 5)])
def test_interval_join(spark, width, crowd):
    pick = random.Random(3)
    def spans(count):
        out = []
        for k in range(count):
            start = pick.choice([None, *map(float, range(-5, 40))])
            long = pick.choice([0.0, 0.0, 1.0, 3.0, 20.0, -1.0, None])
            out.append((k, pick.choice(["hot", "hot", "b", None]), start, None if start is None or long is None else start + long))
        return out
    left, right = spans(90), spans(80)
    schema = "{0} INT, key STRING, start DOUBLE, stop DOUBLE"
    got = temporal.interval_join(spark.createDataFrame(left, schema.format("id")), spark.createDataFrame(right, schema.format("rid")), ["key"], ("start", "stop"), ("start", "stop"), width, max_bin_rows=crowd)
    good = lambda a, b: a is not None and b is not None and a <= b
    expected = [(i, r) for i, k, a, b in left for r, o, c, d in right if k == o and good(a, b) and good(c, d) and a <= d and c <= b]
    assert rows(got, "id", "other_rid") == sorted(expected, key=repr) and expected
    assert not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(plan_of(got).replace("(", " ").split())
    assert temporal.interval_join(spark.createDataFrame([], schema.format("id")), spark.createDataFrame(right, schema.format("rid")), ["key"], ("start", "stop"), ("start", "stop"), width).count() == 0


@pytest.mark.parametrize("count", [0, 1, 200])
def test_global_rank(spark, count):
    pick = random.Random(4)
    values = [(k, pick.choice([None, 1, 1, 1, 1, 2, 3, pick.randrange(50)])) for k in range(count)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several partitions share one value
    try:
        got = rows(ranking.global_rank(spark.createDataFrame(values, "id INT, v INT"), ["v"]), "id", "v", "rank", "dense_rank", "percent_rank")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    key = lambda v: (v is None, v or 0)
    ordered = sorted(key(v) for _, v in values)
    distinct = sorted(set(ordered))
    assert got == sorted([(k, v, ordered.index(key(v)) + 1, distinct.index(key(v)) + 1, ordered.index(key(v)) / (count - 1) if count > 1 else 0.0) for k, v in values], key=repr)


def test_top_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"), "id")
    top = ranking.top_per_group(df, ["g"], [F.desc("v"), "id"], 4)
    expected = [(g, *row, n) for g in range(3) for n, row in enumerate(sorted(((-(k % 7), k) for k in range(500) if k % 3 == g))[:4], 1)]
    assert rows(top, "g", "v", "id", "place") == sorted([(g, -v, k, n) for g, v, k, n in expected], key=repr)
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_differences_count_repeats(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "b"), (3, "c")], "k INT, v STRING")
    two = spark.createDataFrame([(None, 1), ("b", 2), ("b", 2), ("d", 4)], "v STRING, k INT")
    assert rows(ranking.differences(one, two), "k", "v", "only_one", "only_two") == sorted([(1, None, 1, 0), (2, "b", 0, 1), (3, "c", 1, 0), (4, "d", 0, 1)], key=repr)
    assert ranking.differences(one, one).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        ranking.differences(one, two.withColumn("x", F.lit(1)))


def test_rows_are_compared_by_digests_first(spark, monkeypatch):
    """Only hashes are counted; values that change places with a NULL are another row, and of equal tables no whole row is compared."""
    seen, stage = [], ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df: (seen.append(df), stage(df))[1])
    one = spark.createDataFrame([("a", None, 1.0, [1]), (None, "b", 0.0, None), (None, None, None, None), (None, None, None, None)], "k STRING, v STRING, x DOUBLE, l ARRAY<INT>")
    two = spark.createDataFrame([(None, "a", 1.0, [1]), (None, "b", -0.0, None), (None, None, None, None)], "k STRING, v STRING, x DOUBLE, l ARRAY<INT>")
    assert rows(ranking.differences(one, two), "k", "v", "x", "only_one", "only_two") == sorted(
        [("a", None, 1.0, 1, 0), (None, "a", 1.0, 0, 1), (None, None, None, 1, 0)], key=repr)
    assert seen[0].columns == ["__digest", "__other_digest"]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(__digest" in plan and not any(f"hashpartitioning({c}#" in plan for c in "kvxl")



def test_cube_tells_null_keys_from_totals(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 6), (None, 1, 5), (None, None, 5)], "g STRING, p INT, who INT")
    got = rows(summaries.cube(df, ["g", "p"], {"n": F.count(F.lit(1)), "people": F.countDistinct("who")}), "g", "is_total_g", "p", "is_total_p", "n", "people")
    assert (None, False, None, True, 2, 1) in got and (None, True, None, True, 4, 2) in got and (None, True, None, False, 2, 2) in got and len(got) == 9


def test_sketches_merge_like_one(spark):
    df = spark.range(20_000).select((F.col("id") % 5).alias("season"), F.lit("x").alias("kind"), (F.col("id") % 7_000).alias("who"), F.col("id").cast("double").alias("v"))
    guess = summaries.merged(summaries.sketched(df, ["season", "kind"], "who", "v"), ["kind"]).first()
    assert abs(guess.n_members - 7_000) <= summaries.DISTINCT_ERROR * 7_000 and guess.n_values == 20_000
    assert abs(guess.q50 - 10_000) <= summaries.RANK_ERROR * 20_000 and abs(guess.q90 - 18_000) <= summaries.RANK_ERROR * 20_000


def at(minute, second=0):
    return datetime.datetime(2024, 1, 1, 10, minute, second)


def test_streamed_score_in_order_with_late_rows_and_restart(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "check"))
    far = [(score.CLOSING_GAME, 0, datetime.datetime(2100, 1, 1), 0, 0)]
    landings = [[(1, 2, at(2), 0, 3), (1, 1, at(1), 2, 0), (2, 1, at(20), 1, 0)],  # out of order inside a file
                [(1, 4, at(30), 2, 0), (1, 3, at(16), 0, 1), (2, 2, at(4), 9, 9)],  # at(4) lies behind the watermark of at(20) - 10 minutes
                [(1, 5, at(31), 1, 0), (2, 3, at(30), 1, 1)], far]
    for landing in landings:  # each run ends and starts again from the checkpoint
        spark.createDataFrame(landing, score.EVENTS).coalesce(1).write.mode("append").parquet(source)
        score.run(score.running_score(score.read_events(spark, source, files=1), "10 minutes"), target, checkpoint)
    got = rows(spark.read.schema(score.SCORED).parquet(target).where("game_id > 0"), "game_id", "number_event", "hs", "vs")
    assert got == [(1, 1, 2, 0), (1, 2, 2, 3), (1, 3, 2, 4), (1, 4, 4, 4), (1, 5, 5, 4), (2, 1, 1, 0), (2, 3, 2, 1)]


def test_advance_emits_in_order():
    state, waiting, out = score.advance((1, 0), [(5, 2, 1, 0), (3, 1, 0, 2), (9, 3, 1, 1)], 5)
    assert state == (2, 2) and waiting == [(9, 3, 1, 1)] and out == [(1, 3, 1, 2), (2, 5, 2, 2)]


def test_one_call_scores_a_block_of_games():
    import pandas as pd

    class State:
        exists, get = True, ([(7, 2, 1)], [(None, 4, 1, 1, 0)])
        def getCurrentWatermarkMs(self): return 1
        def update(self, value): self.kept = value
        def setTimeoutTimestamp(self, at): self.at = at
    state = State()
    batch = pd.DataFrame({"game_id": [7, 8, 8], "number_event": [5, 6, 7], "ts": pd.to_datetime([10, 20, 5000], unit="us"), "home": [1, 0, 9], "away": [0, 3, 9]})
    out, = score._score((0,), iter([batch]), state)
    got = [tuple(None if v is pd.NA else v for v in row) for row in out.drop(columns="ts").itertuples(index=False)]
    assert got == [(None, 1, 1, 0), (7, 5, 3, 1), (8, 6, 0, 3)]
    assert state.kept == ([(7, 3, 1), (None, 1, 0), (8, 0, 3)], [(8, 5000, 7, 9, 9)]) and state.at == 5
