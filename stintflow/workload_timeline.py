"""Registered queries of the joins on time, ranks, sessions, cubes, sketches and streams, each over whole given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import fixtures as fx
from .operators import ranking, summaries, temporal
from .plans import season
from .sources.shared import new_path
from .session import tune
from .streaming import score
from .workload import event_log, query


def _moments(spark, sf_dir):
    """``events`` with a hot key for a third of them, NULL keys, NULL times, and times cut to the minute so that many are equal."""
    number = F.col("event_id")
    group = F.when(number % 3 == 0, -1).when(number % 13 != 0, F.col("user_id"))
    return fx.table(spark, sf_dir, "events").select(
        number, group.alias("user_key"), F.when(number % 11 != 0, F.date_trunc("minute", "ts")).alias("at"), "event_type", "value")


@query
def asof_join(spark, sf_dir):
    """The last view of the same key at or before each purchase, not more than six hours back."""
    rows = _moments(spark, sf_dir)
    views = rows.where("event_type = 'view'").select("user_key", "at", F.col("event_id").alias("view_id"), "value")
    bought = rows.where("event_type = 'purchase'").select("event_id", "user_key", "at")
    return temporal.asof_join(bought, views, ["user_key"], "at", "at", ["view_id", "value"], tolerance=6 * 3600.0)


@query
def asof_score(spark, sf_dir):
    """Score at the last scoring event at or before each foul of a game."""
    log = event_log(spark, sf_dir).frame()
    fouls = log.where("msg_type = 6").select("game_id", "number_event", "secs_passed_game")
    scored = log.where("shot_pts > 0").select("game_id", "secs_passed_game", F.col("number_event").alias("scored_at"), "hs", "vs")
    return temporal.asof_join(fouls, scored, ["game_id"], "secs_passed_game", "secs_passed_game", ["scored_at", "hs", "vs"], ties=["scored_at"], prefix="").drop("secs_passed_game")


@query
def interval_join(spark, sf_dir):
    """Pairs of overlapping spans of one key: clicks of minutes, errors of up to some days."""
    rows = _moments(spark, sf_dir)
    minutes = lambda n: F.col("at") + F.make_dt_interval(mins=n)
    clicks = rows.where("event_type = 'click'").select("event_id", "user_key", "at", minutes((F.col("event_id") % 20).cast("int")).alias("until"))
    long = F.when(F.col("event_id") % 29 == 0, 3000).otherwise(F.col("event_id") % 90).cast("int")
    errors = rows.where("event_type = 'error'").select("event_id", "user_key", "at", minutes(long).alias("until"))
    return temporal.interval_join(clicks, errors, ["user_key"], ("at", "until"), ("at", "until"), 1800.0).select("event_id", "user_key", "other_event_id")


@query
def global_rank(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 17 != 0, F.col("l_quantity")).alias("quantity"), "l_discount")
    return ranking.global_rank(lines, ["quantity", "l_discount"])


@query
def top_lineups(spark, sf_dir):
    """Of every team the three line-ups of a game with the most points; the name decides between equals."""
    tune(spark)
    stints = season.existing_stats(season.enriched_events(fx.landed(spark, sf_dir)))
    sums = stints.groupBy("slug_team", "game_id", "lineup").agg(F.sum("pts_team").alias("pts"))
    return ranking.top_per_group(sums, ["slug_team"], [F.desc_nulls_last("pts"), "lineup", "game_id"], 3)


@query
def table_differences(spark, sf_dir):
    """Order lines against the same lines with some changed, some gone and some doubled."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 2, F.col("l_linenumber")).alias("line"), "l_quantity")
    key = F.col("l_orderkey")
    other = lines.where(key % 50 != 0).withColumn("l_quantity", F.when(key % 31 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return ranking.differences(lines, other.unionByName(other.where(key % 23 == 0)))


@query
def stats_cube(spark, sf_dir):
    """Points and distinct players by season, team and period, and all their totals; some events have no team."""
    feed = fx.feed(spark, sf_dir).select((2021 + F.col("game_id") % 3).alias("season"), F.col("team_id").alias("team"), "period", "desc_value", F.col("player1_id").alias("player"))
    return summaries.cube(feed, ["season", "team", "period"], {
        "n_events": F.count(F.lit(1)), "total_value": F.sum("desc_value"), "n_players": F.countDistinct("player")})


@query
def stats_rollup(spark, sf_dir):
    feed = fx.feed(spark, sf_dir).select((2021 + F.col("game_id") % 3).alias("season"), F.col("team_id").alias("team"), "msg_type")
    return summaries.cube(feed, ["season", "team", "msg_type"], {"n_events": F.count(F.lit(1))}, rollup=True)


@query
def event_sessions(spark, sf_dir):
    return summaries.sessions(_moments(spark, sf_dir), ["user_key"], "at", "3 hours", {"n_events": F.count(F.lit(1)), "first_event": F.min("event_id"), "total": F.sum(F.round(F.col("value") * 100).cast("long"))})


@query
def event_sessions_stream(spark, sf_dir):
    """The same sessions from a stream of files; a last row far ahead closes them all."""
    source, target = new_path(spark, "events"), new_path(spark, "sessions")
    rows = _moments(spark, sf_dir).select("event_id", "user_key", "at", F.round(F.col("value") * 100).cast("long").alias("cents"))
    rows.where("at IS NOT NULL").write.parquet(source)
    rows.limit(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(-2).cast("long").alias("user_key"), F.lit("2100-01-01").cast("timestamp").alias("at"), F.lit(0).cast("long").alias("cents")) \
        .write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source).withWatermark("at", "1 hour")
    found = summaries.sessions(stream, ["user_key"], "at", "3 hours", {"n_events": F.count(F.lit(1)), "first_event": F.min("event_id"), "total": F.sum("cents")})
    score.run(found, target, new_path(spark, "checkpoint"))
    return spark.read.parquet(target).where("user_key IS NULL OR user_key > -2")


@query
def sketch_players(spark, sf_dir):
    """Sketches per day and kind, merged per kind, against the exact answers: each row says that they lie within the stated error."""
    rows = fx.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), F.col("event_id").alias("member"), "value")
    path = new_path(spark, "sketches")
    summaries.sketched(rows, ["day", "kind"], "member", "value").write.parquet(path)
    guessed = summaries.merged(spark.read.parquet(path), ["kind"])
    exact = rows.groupBy("kind").agg(F.countDistinct("member").alias("exact"), F.count("value").alias("n"))
    places = rows.join(guessed.select("kind", "q50", "q90"), "kind").groupBy("kind").agg(
        *[F.sum(F.when(F.col("value") <= F.col(q), 1).otherwise(0)).alias(f"upto_{q}") for q in ("q50", "q90")],
        *[F.sum(F.when(F.col("value") < F.col(q), 1).otherwise(0)).alias(f"below_{q}") for q in ("q50", "q90")])
    def held(q: str, share: float):
        return (F.col(f"below_{q}") <= (share + summaries.RANK_ERROR) * F.col("n")) & (F.col(f"upto_{q}") >= (share - summaries.RANK_ERROR) * F.col("n"))
    return guessed.join(exact, "kind").join(places, "kind").select(
        "kind", "n_values", "exact", (F.abs(F.col("n_members") - F.col("exact")) <= summaries.DISTINCT_ERROR * F.col("exact")).alias("members_held"),
        held("q50", 0.5).alias("q50_held"), held("q90", 0.9).alias("q90_held"))


def scored_feed(spark, sf_dir):
    """``events`` as scoring events with the third of the month they arrive in; every 97th arrives one third late."""
    number, kind = F.col("event_id"), F.col("event_type")
    points = F.when(kind == "click", 2).when(kind == "purchase", 1).otherwise(0)
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    return fx.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("game_id"), number.alias("number_event"), "ts", F.when(number % 2 == 0, points).otherwise(0).cast("int").alias("home"),
        F.when(number % 2 == 1, points).otherwise(0).cast("int").alias("away"), F.least(third + F.when(number % 97 == 0, 1).otherwise(0), F.lit(2)).cast("int").alias("third"))


@query
def stream_score(spark, sf_dir):
    """Running score of every game from three landings of files; what lands half a day behind the watermark is dropped."""
    source, target, checkpoint = new_path(spark, "feed"), new_path(spark, "scores"), new_path(spark, "checkpoint")
    feed = scored_feed(spark, sf_dir)
    closing = feed.limit(1).select(F.lit(score.CLOSING_GAME).cast("long").alias("game_id"), F.lit(0).cast("long").alias("number_event"), F.lit("2100-01-01").cast("timestamp").alias("ts"),
                                   F.lit(0).alias("home"), F.lit(0).alias("away"))
    for landing in (feed.where("third = 0").drop("third"), feed.where("third = 1").drop("third"), feed.where("third = 2").drop("third"), closing):
        landing.write.mode("append").parquet(source)
        score.run(score.running_score(score.read_events(spark, source), "12 hours"), target, checkpoint)
    return spark.read.schema(score.SCORED).parquet(target).where(F.col("game_id") != score.CLOSING_GAME)
