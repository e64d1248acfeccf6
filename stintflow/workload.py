"""The registered queries: one per operator key of the inventory, each over whole given tables."""
from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import fixtures as fx
from .functions import (clock_seconds, extract_first, ifelse_na, not_in, period_start_seconds, replace_first,
                        seconds_passed_game, sorted_names, split_names, sum_na)
from .operators import ranking, verbs
from .operators.scan import (EventLog, fill_down, fill_up, following, previous, row_count, running_sum, scan)
from .plans import events, fouls, garbage, lineups, possessions, schedule, season, stats
from .sources import compact, files, publish
from .session import tune
from .sources.shared import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STAMPED_AT = datetime.datetime(2024, 6, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def event_log(spark: SparkSession, sf_dir: str) -> EventLog:
    tune(spark)
    return events.sequence_events(fx.feed(spark, sf_dir), fx.player_logs(spark, sf_dir))


def starts_of(spark: SparkSession, sf_dir: str, log: EventLog) -> DataFrame:
    logs = fx.player_logs(spark, sf_dir)
    return lineups.starting_lineups(lineups.all_starters(log.frame(), logs, fx.period_box(spark, sf_dir)), logs)


def possession_log(spark: SparkSession, sf_dir: str) -> EventLog:
    return event_log(spark, sf_dir).apply(possessions.possessions)


# ---- sources and sinks

@query
def scan_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    files.write_csv(fx.table(spark, sf_dir, "customer"), path)
    return files.scan_csv(spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING")


@query
def scan_season_files(spark, sf_dir):
    path = new_path(spark, "seasons")
    orders = fx.table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    files.write_parquet(orders.select("o_orderkey", "o_custkey", "o_totalprice", "season"), path, "season")
    return files.scan_seasons(spark, path).select("o_orderkey", "o_custkey", "o_totalprice", "season")


@query
def season_from_filename(spark, sf_dir):
    path = new_path(spark, "names")
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.year("l_shipdate").alias("box"))
    files.write_csv(rows, path, "box")
    read = files.scan_seasons(spark, path, "csv", "l_orderkey BIGINT, l_quantity DOUBLE")
    return read.groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@query
def json_pluck(spark, sf_dir):
    """Documents over several lines, many to a file, and one file that breaks off: its text stays as a row of its own."""
    path = new_path(spark, "json")
    games = fx.table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 4000).alias("file"), F.to_json(F.struct("o_orderkey", F.struct(F.array(
        F.struct(F.lit("away").alias("side"), (F.col("o_custkey") % 12).alias("team_id")),
        F.struct(F.lit("home").alias("side"), ((F.col("o_custkey") + 5) % 12).alias("team_id"))).alias("game_log")).alias("frames"))).alias("doc"))
    whole = games.groupBy("file").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("doc"), ",\n"), F.lit("\n]")).alias("value"))
    broken = whole.orderBy("file").limit(1).select(F.lit(-1).cast("long").alias("file"), F.substring("value", 1, 60).alias("value"))
    whole.unionByName(broken).write.partitionBy("file").text(path)
    docs = stage(files.scan_json(spark, path, "o_orderkey BIGINT, frames STRUCT<game_log: ARRAY<STRUCT<side: STRING, team_id: BIGINT>>>", multi_line=True))
    plucked = files.pluck(docs, "frames.game_log", "o_orderkey")
    return plucked.unionByName(docs.where("_corrupt IS NOT NULL").select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit("broken").alias("side"), F.length("_corrupt").cast("bigint").alias("team_id")))


@query
def sink_json(spark, sf_dir):
    path = new_path(spark, "json")
    files.write_json(fx.player_logs(spark, sf_dir), path, "season_id")
    return spark.read.schema(
        "game_id INT, game_date DATE, player_id INT, player_name STRING, team_location STRING, season_id INT").json(path)


@query
def sink_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    files.write_csv(fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"), path, "l_returnflag")
    return files.scan_csv(spark, path, "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, "
                                       "l_quantity DOUBLE, l_discount DOUBLE, l_returnflag STRING")


@query
def sink_parquet(spark, sf_dir):
    path = new_path(spark, "parquet")
    files.write_parquet(fx.table(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate")).drop("o_orderdate"), path, "season")
    return spark.read.parquet(path)


@query
def season_rebuild(spark, sf_dir):
    """One season written again, with other values, in every format; the other seasons stay."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("season"))
    again = orders.where("season = 1995").withColumn("o_custkey", F.col("o_custkey") + 1)
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, season INT"
    read = []
    for fmt, write in files.WRITERS.items():
        path = new_path(spark, f"rebuild-{fmt}")
        write(orders, path, "season")
        write(again, path, "season")
        read.append(spark.read.format(fmt).option("header", True).schema(schema).load(path).withColumn("format", F.lit(fmt)))
    return files.union_seasons(read)


@query
def republish_dataset(spark, sf_dir):
    """Eight datasets from a stored configuration, each landed by season and published in two formats."""
    landed, target = new_path(spark, "landed"), new_path(spark, "published")
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("game_id"),
        F.col("o_totalprice").alias("status_display_clock"), "o_orderstatus", F.year("o_orderdate").alias("season"), (F.col("o_orderkey") % 8).alias("n"))
    chosen = publish.datasets()[:8]
    named = orders.withColumn("dataset", F.element_at(F.array(*[F.lit(dataset.name) for dataset in chosen]), (F.col("n") + 1).cast("int"))).drop("n")
    files.write_parquet(named, landed, "dataset", "season")
    config = [(dataset.name, dataset.title, f"{landed}/dataset={dataset.name}") for dataset in chosen]
    published = publish.republish_all(spark, publish.save_registry(spark, config, new_path(spark, "registry")), target, updated_at=STAMPED_AT)
    columns = "id STRING, game_id STRING, status_display_clock STRING, o_orderstatus STRING, _source STRING, _updated_at TIMESTAMP, season INT"
    back = []
    for name, paths in published.items():
        read = {"csv": spark.read.option("header", True).schema(columns).csv(paths["csv"]), "parquet": spark.read.parquet(paths["parquet"])}
        back += [df.select(F.lit(name).alias("dataset"), F.col("id").cast("int").alias("id"), F.col("game_id").cast("int").alias("game_id"),
                           F.col("status_display_clock").cast("string").alias("status_display_clock"), "o_orderstatus", "_source", "season",
                           F.lit(fmt).alias("format")) for fmt, df in read.items()]
    return files.union_seasons(back)


@query
def json_compact(spark, sf_dir):
    """A folder of small documents over several lines, one of them broken, rewritten as one document a line."""
    source, target = new_path(spark, "documents"), new_path(spark, "compact")
    events = fx.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 500).alias("doc_id"), F.struct("event_id", "props").alias("event"))
    docs = events.groupBy("doc_id").agg(F.array_sort(F.collect_list("event")).alias("events")).select(
        "doc_id", F.concat(F.lit("[ "), F.array_join(F.transform("events", lambda e: e["props"]), " ,\n  "), F.lit(" ]")).alias("value"))
    broken = docs.orderBy("doc_id").limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit('{"k": 1').alias("value"))
    docs.unionByName(broken).write.partitionBy("doc_id").text(source)
    compact.compact_folder(spark, source, target)
    return spark.read.schema("doc_id BIGINT, doc STRING, _corrupt STRING").json(target)


@query
def provenance_stamp(spark, sf_dir):
    return publish.stamp(fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "Supplier rows", STAMPED_AT).withColumn(
        "_updated_at", F.date_format("_updated_at", "yyyy-MM-dd HH:mm:ss"))


@query
def dataset_registry(spark, sf_dir):
    """The stored registry of twelve datasets, each read from a given table, with their numbers of rows."""
    names = ("orders", "lineitem", "customer", "events", "part", "supplier", "documents", "labels", "pages",
             "conversations", "embeddings", "benchmark")
    rows = [(dataset.name, dataset.title, f"{sf_dir}/{name}.parquet") for dataset, name in zip(publish.datasets(), names)]
    return publish.counted_registry(publish.save_registry(spark, rows, new_path(spark, "registry")))


# ---- projections, filters, predicates

@query
def filter_events(spark, sf_dir):
    rows = event_log(spark, sf_dir).frame()
    return rows.where(F.col("msg_type").isin(1, 2, 3, 12) & not_in(F.col("off_slug_team"), ["T04"])).select(
        "game_id", "number_event", "msg_type", "off_slug_team")


@query
def group_filter(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    returned = F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)) > 0
    return verbs.group_filter(lines, ["l_orderkey"], returned & (F.max("l_quantity") >= 45))


@query
def group_filter_null(spark, sf_dir):
    """A NULL group passes like any other and keeps its rows."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("supplier"), "l_quantity")
    passed = verbs.group_filter(lines, ["supplier"], F.max("l_quantity") >= 30)
    return verbs.attach_aggregates(passed, ["supplier"], {"n_lines": F.count(F.lit(1)), "least": F.min("l_quantity")})


@query
def select_rename(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("customer"), F.col("c_nationkey")).withColumnRenamed(
        "c_nationkey", "nation_id").drop("c_name")


@query
def select_helpers(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    picked = [*verbs.column_range(lines, "l_orderkey", "l_linenumber"), *verbs.columns_where(lines, contains="tax"),
              *verbs.columns_where(lines, prefix="l_ship")]
    wanted = verbs.select_any(lines.select(*picked), {"order_id": "l_orderkey", "part_id": "l_partkey", "supplier_id": "l_suppkey",
                                                      "tax": "l_tax", "gone": "l_gone", "shipped": "l_shipdate"})
    return verbs.columns_first(wanted.withColumn("shipped", F.col("shipped").cast("date")), "tax")


@query
def with_columns(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")
    return (lines.withColumn("disc_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))
            .withColumn("charge", F.col("disc_price") * (1 + F.col("l_tax"))))


@query
def across_cast(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("level"))
    return verbs.across(orders, ["level", "o_orderstatus"], lambda c: c.try_cast("int"), "{col}_int")


@query
def clean_names(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    messy = parts.toDF("PART_KEY", "partName", "Brand Name", "P.Type", "locX", "Retail Price ($)")
    return verbs.clean_names(messy)


@query
def distinct_keys(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status")).distinct()


# ---- joins

@query
def left_join(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customers, "o_custkey", "left")


@query
def left_join_renamed(spark, sf_dir):
    nations = fx.table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(nations, "c_nationkey", "left")


@query
def dim_lookup(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    names = verbs.lookup_table(fx.table(spark, sf_dir, "part"), "p_partkey", "p_name", new_key="l_partkey", new_value="part_name")
    return lines.select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity").join(names, "l_partkey", "left")


@query
def anti_join(spark, sf_dir):
    log, logs = event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir)
    named = log.select("game_id", "period", F.col("player1").alias("player_name")).where(F.col("player_name").isNotNull()).distinct()
    return named.join(lineups.players_subbed(log, logs), ["game_id", "period", "player_name"], "left_anti")


@query
def fallback_join(spark, sf_dir):
    rows = fouls.with_link_roles(event_log(spark, sf_dir).frame()).where(F.col("link_family") == "regular")
    keys = ["game_id", "secs_passed_game", "link_team"]
    throws = rows.where(F.col("msg_type") == 3).select(*keys, "link_player", F.col("number_event").alias("number_event_ft"))
    causes = rows.where(F.col("msg_type") == 6).select(*keys, "link_player", F.col("number_event").alias("number_event_foul"))
    return verbs.fallback_join(throws, causes, keys + ["link_player"], keys, "number_event_foul").select(
        "game_id", "number_event_ft", "number_event_foul")


@query
def rows_update(spark, sf_dir):
    """Orders, some without a key, updated by key; the change without a key goes to all of those."""
    orders = fx.table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderkey")).alias("key"), "o_orderkey", "o_orderstatus", "o_totalprice")
    changes = orders.where((F.col("o_orderstatus") == "P") & F.col("key").isNotNull()).select("key", F.when(F.col("o_totalprice") > 200000, "X").alias("o_orderstatus"))
    unknown = changes.groupBy().agg(F.lit(None).cast("bigint").alias("key"), F.lit("N").alias("o_orderstatus"))
    return verbs.rows_update(orders, changes.unionByName(unknown), ["key"])


@query
def semi_join_missing(spark, sf_dir):
    found = lineups.period_starters(event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir))
    box = fx.period_box(spark, sf_dir).withColumnRenamed("team_abbreviation", "slug_team")
    return box.join(lineups.starters_missing(found), lineups.PERIOD_TEAM, "left_semi").select(
        "game_id", "period", "slug_team", "player_id", "min")


# ---- aggregation, distinct, reshape

@query
def group_sum(spark, sf_dir):
    rows = event_log(spark, sf_dir).frame()
    return rows.groupBy("game_id", "period", "msg_type", "team_home").agg(
        F.count(F.lit(1)).alias("n"), sum_na(F.col("desc_value")).alias("total_value"), F.sum("shot_pts").alias("total_pts"))


@query
def group_size_check(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != 10)


@query
def dup_keys(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


@query
def first_per_key(spark, sf_dir):
    """Some orders have no date: they come last."""
    orders = fx.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("date")))
    return verbs.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def cond_window_agg(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    returned = F.col("l_returnflag") == "R"
    return verbs.attach_aggregates(lines, ["l_orderkey"], {
        "any_returned": F.sum(F.when(returned, 1).otherwise(0)) > 0, "max_kept": F.max(F.when(~returned, F.col("l_quantity")))})


@query
def set_string_agg(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(sorted_names(F.collect_set("o_orderpriority")).alias("priorities"))


@query
def pivot_first(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate").cast("date")))
    return verbs.pivot_first(orders, ["o_custkey"], "o_orderstatus", ["o_orderkey", "o_totalprice"], ["F", "O", "P"],
                             ["o_orderdate", "o_orderkey"])


@query
def unpivot_cols(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("l_tax"))
    return verbs.unpivot_columns(lines, ["l_orderkey", "l_partkey", "l_suppkey"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount", "l_")


@query
def union_by_name(spark, sf_dir):
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = fx.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    nobody = suppliers.where(F.col("id") < 0)
    return files.union_seasons([customers, suppliers, nobody])


# ---- ordered rows

@query
def renumber_events(spark, sf_dir):
    return event_log(spark, sf_dir).frame().select("game_id", "number_event", "number_original", "msg_type")


@query
def running_score(spark, sf_dir):
    return event_log(spark, sf_dir).frame().select("game_id", "number_event", "shot_pts", "hs", "vs")


@query
def lag_lead(spark, sf_dir):
    log = event_log(spark, sf_dir).apply(scan, ["game_id"], ["number_event"], {
        "prev_type": previous(F.col("msg_type")), "next_type": following(F.col("msg_type")),
        "next_secs": following(F.col("secs_passed_game"))})
    return log.frame().select("game_id", "number_event", "prev_type", "next_type", "next_secs")


@query
def fill_forward(spark, sf_dir):
    scored = F.when(F.col("msg_type").isin(1, 3), F.col("slug_team"))
    log = event_log(spark, sf_dir).apply(scan, ["game_id", "period"], ["number_event"], {"last_scorer": fill_down(scored)})
    return log.frame().select("game_id", "number_event", "last_scorer")


@query
def fill_backward(spark, sf_dir):
    scored = F.when(F.col("msg_type").isin(1, 3), F.col("slug_team"))
    log = event_log(spark, sf_dir).apply(scan, ["game_id", "period"], ["number_event"], {"next_scorer": fill_up(scored)})
    return log.frame().select("game_id", "number_event", "next_scorer")


@query
def last_per_group(spark, sf_dir):
    """Rows whose order is unknown come last of their group, so one of them is its last row."""
    rows = event_log(spark, sf_dir).frame().where(F.col("msg_type").isin(1, 2, 3, 4, 5))
    rows = rows.select("game_id", "period", "number_event", "msg_type", "clock", F.when(F.col("number_event") % 5 != 0, F.col("number_event")).alias("known"))
    return verbs.last_per_key(rows, ["game_id", "period"], ["known", "number_event"])


@query
def first_row_default(spark, sf_dir):
    log = event_log(spark, sf_dir).apply(scan, ["game_id", "slug_team"], ["number_event"], {"row": row_count()})
    return log.frame().select("game_id", "number_event", F.when(F.col("row") == 1, F.col("clock")).alias("first_clock"))


@query
def time_to_next(spark, sf_dir):
    log = event_log(spark, sf_dir).apply(scan, ["game_id", "period"], ["number_event"], {"next_secs": following(F.col("secs_passed_game"))})
    return log.frame().select("game_id", "number_event",
                              F.coalesce(F.col("next_secs") - F.col("secs_passed_game"), F.lit(0.0)).alias("secs_played"))


@query
def nth_pairing(spark, sf_dir):
    shots = EventLog(tuple(part.where(F.col("msg_type").isin(1, 2)) for part in event_log(spark, sf_dir).parts))
    numbered = shots.apply(scan, ["game_id", "period", "msg_type"], ["number_event"], {"n": row_count()}).frame()
    named = numbered.withColumn("kind", F.when(F.col("msg_type") == 1, "made").otherwise("missed"))
    return verbs.pivot_first(named, ["game_id", "period", "n"], "kind", ["number_event"], ["made", "missed"], ["number_event"])


@query
def lineup_fold(spark, sf_dir):
    log = event_log(spark, sf_dir)
    starts = stage(starts_of(spark, sf_dir, log))
    return log.apply(lineups.lineup_changes, starts).frame().select(
        "game_id", "period", "number_event", "slug_team", "lineup_before", "lineup_after")


# ---- arrays and scalars

@query
def array_set_ops(spark, sf_dir):
    starts = starts_of(spark, sf_dir, event_log(spark, sf_dir)).select("game_id", "period", "slug_team", split_names(F.col("lineup_start")).alias("now"))
    later = starts.select("game_id", (F.col("period") - 1).alias("period"), "slug_team", F.col("now").alias("later"))
    return starts.join(later, lineups.PERIOD_TEAM, "left").select(
        *lineups.PERIOD_TEAM, F.size("now").alias("n_now"), F.coalesce(F.size(F.array_intersect("now", "later")), F.lit(0)).alias("n_stay"),
        sorted_names(F.array_except("later", "now")).alias("new_names"),
        F.size(F.array_distinct(F.transform("now", lambda name: F.substring(name, 1, 1)))).alias("n_letters"))


@query
def regex_flags(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", F.col("url").rlike("^https://").alias("is_https"),
                                                   F.col("url").rlike(r"/(fr|de)/").alias("is_fr_de"), extract_first(F.col("url"), r"\d+").alias("first_number"))


@query
def regex_replace_first(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select("p_partkey", replace_first(F.col("p_name"), "e", "Double e").alias("new_name"),
                                                  F.regexp_replace("p_brand", r"#\d+$", "").alias("brand"))


@query
def split_join(spark, sf_dir):
    words = F.split("p_name", " ")
    return fx.table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(F.array_sort(words), ", ").alias("sorted_words"), F.concat(F.lit("AWAY_"), "p_brand").alias("tagged"),
        sorted_names(F.split(F.when(F.col("p_size") > 10, F.col("p_name")), " ")).alias("maybe_words"))


@query
def separate_cols(spark, sf_dir):
    pieces = F.split("o_orderpriority", "[- ]")
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.get(pieces, 0).try_cast("int").alias("level"), F.get(pieces, 1).alias("word1"), F.get(pieces, 2).alias("word2"))


@query
def null_safe_ifelse(spark, sf_dir):
    return event_log(spark, sf_dir).frame().select(
        "game_id", "number_event", ifelse_na(F.col("slug_team") == F.col("team_home"), F.col("team_away"), F.col("team_home")).alias("opponent"),
        ifelse_na(F.col("desc_value") > 1, F.lit("big"), F.lit("small")).alias("size"))


@query
def case_when(spark, sf_dir):
    price = F.col("o_totalprice")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.when(price < 100000, "low").when(price < 300000, "mid").when(
        F.col("o_orderstatus") == "F", "high closed").otherwise("high").alias("band"))


@query
def coalesce_fill(spark, sf_dir):
    return event_log(spark, sf_dir).frame().select("game_id", "number_event", F.coalesce("player3", "player1", F.lit("nobody")).alias("player"),
                                                   F.coalesce("desc_value", F.lit(0)).alias("desc_value"))


@query
def clock_to_seconds(spark, sf_dir):
    return fx.feed(spark, sf_dir).select(
        "game_id", "number_event", clock_seconds(F.col("clock")).alias("secs_left"), period_start_seconds(F.col("period")).alias("secs_start"),
        seconds_passed_game(F.col("period"), F.col("clock")).alias("secs_passed_game"))


# ---- schedules

@query
def schedule_pairs(spark, sf_dir):
    return schedule.pair_schedule(fx.team_game_log(spark, sf_dir).drop("SEASON_TYPE"))


def _season_schedule(spark, sf_dir):
    games, kind = fx.team_game_log(spark, sf_dir), F.col("SEASON_TYPE")
    return schedule.season_schedule(games.where(kind == "Regular").drop("SEASON_TYPE"), games.where(kind == "Playoffs").drop("SEASON_TYPE"))


@query
def schedule_season(spark, sf_dir):
    return _season_schedule(spark, sf_dir)


@query
def schedule_master(spark, sf_dir):
    """Schedules written by season and as master tables, in both formats, and read back from all four."""
    paths = schedule.write_schedules(_season_schedule(spark, sf_dir), new_path(spark, "schedules"))
    columns = "GAME_ID BIGINT, GAME_DATE DATE, MATCHUP STRING, AWAY_WL STRING, AWAY_TEAM_ID INT, AWAY_PTS INT, HOME_WL STRING, HOME_TEAM_ID INT, HOME_PTS INT, season INT"
    back = []
    for fmt, path in paths.items():
        rows = spark.read.option("header", True).schema(columns).csv(path) if fmt.endswith("csv") else schedule.master_schedule(spark, path)
        back.append(rows.withColumn("written", F.lit(fmt)))
    return files.union_seasons(back)


# ---- event preparation

@query
def player_log_prep(spark, sf_dir):
    return fx.player_logs(spark, sf_dir)


@query
def event_names(spark, sf_dir):
    return events.attach_names(fx.feed(spark, sf_dir), fx.player_logs(spark, sf_dir)).select(
        "game_id", "number_event", "slug_team", "off_slug_team", "player1", "player2", "player3")


@query
def game_teams(spark, sf_dir):
    return events.game_teams(fx.player_logs(spark, sf_dir))


# ---- line-ups

@query
def players_subbed(spark, sf_dir):
    return lineups.players_subbed(event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir))


@query
def period_starters(spark, sf_dir):
    return lineups.period_starters(event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir))


@query
def starters_missing(spark, sf_dir):
    return lineups.starters_missing(lineups.period_starters(event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir)))


@query
def starters_repair(spark, sf_dir):
    found = lineups.period_starters(event_log(spark, sf_dir).frame(), fx.player_logs(spark, sf_dir))
    return lineups.starters_repair(found, fx.period_box(spark, sf_dir))


@query
def lineup_start(spark, sf_dir):
    return starts_of(spark, sf_dir, event_log(spark, sf_dir))


@query
def lineup_on_event(spark, sf_dir):
    log = season.with_lineups(event_log(spark, sf_dir).stage(), fx.landed(spark, sf_dir))
    return log.frame().select("game_id", "number_event", "lineup_home", "lineup_away")


# ---- possessions

@query
def possession_flag(spark, sf_dir):
    return event_log(spark, sf_dir).apply(possessions.possession_flag).frame().select("game_id", "number_event", "msg_type", "act_type", "possession")


@query
def lane_violations(spark, sf_dir):
    marked = event_log(spark, sf_dir).apply(possessions.possession_flag).apply(possessions.mark_lane_violations).frame()
    return marked.where(F.col("msg_type") == 3).select("game_id", "number_event", "lane_violation")


@query
def jumpball_turnovers(spark, sf_dir):
    marked = event_log(spark, sf_dir).apply(possessions.possession_flag).apply(possessions.mark_jumpball_turnovers).frame()
    return marked.where(F.col("msg_type") == 10).select("game_id", "number_event", "slug_team", "jumpball_turnover")


@query
def consecutive_possessions(spark, sf_dir):
    def marks(part):
        part = possessions.mark_jumpball_turnovers(possessions.mark_lane_violations(possessions.possession_flag(part)))
        return possessions.mark_consecutive(possessions.apply_marks(part))
    return event_log(spark, sf_dir).apply(marks).frame().where("consecutive").select("game_id", "number_event", "off_slug_team")


@query
def possessions_corrected(spark, sf_dir):
    return event_log(spark, sf_dir).apply(possessions.corrected_possessions).frame().select(
        "game_id", "number_event", "possession", "slug_team", "off_slug_team")


@query
def possession_start(spark, sf_dir):
    log = event_log(spark, sf_dir).apply(possessions.corrected_possessions).apply(possessions.with_possession_start)
    return log.frame().select("game_id", "number_event", "clock", "start_poss")


@query
def last_possession(spark, sf_dir):
    return possession_log(spark, sf_dir).frame().select(
        "game_id", "period", "number_event", "number_original", "msg_type", "act_type", "possession", "start_poss", "slug_team",
        "off_slug_team", "description", "clock")


# ---- fouls

@query
def double_technicals(spark, sf_dir):
    marked = event_log(spark, sf_dir).apply(fouls.mark_double_technicals).frame()
    return marked.where((F.col("msg_type") == 6) & (F.col("act_type") == 11)).select(
        "game_id", "number_event", "double_technical", fouls.double_technical_text().alias("description"))


@query
def tech_pairing(spark, sf_dir):
    return event_log(spark, sf_dir).apply(fouls.technical_pairs).frame()


@query
def flagrant_pairing(spark, sf_dir):
    return possession_log(spark, sf_dir).apply(fouls.flagrant_pairs).frame()


@query
def regular_foul_pairing(spark, sf_dir):
    return possession_log(spark, sf_dir).apply(fouls.regular_foul_pairs).frame()


@query
def foul_stats(spark, sf_dir):
    return possession_log(spark, sf_dir).apply(fouls.foul_stats).frame()


@query
def pbp_points_poss(spark, sf_dir):
    log = possession_log(spark, sf_dir).apply(fouls.with_points_and_possessions).frame()
    dated = log.join(events.game_calendar(fx.player_logs(spark, sf_dir)), "game_id", "left")
    return dated.select("game_id", "game_date", "number_event", "shot_pts_home", "shot_pts_away", "poss_home", "poss_away", "secs_played")


# ---- garbage time, roles, ids

@query
def garbage_time(spark, sf_dir):
    tune(spark)
    return season.enriched_events(fx.landed(spark, sf_dir)).frame().select(
        "game_id", "number_event", "total_starters_home", "total_starters_away", "margin_before", "garbage_time")


@query
def off_def_lineups(spark, sf_dir):
    tune(spark)
    rows = season.enriched_events(fx.landed(spark, sf_dir)).frame()
    return rows.select("game_id", "number_event", "def_slug_team", "off_lineup", "def_lineup", *[
        c for c in rows.columns if c.startswith(("off_player", "def_player"))])


@query
def lineup_player_ids(spark, sf_dir):
    tune(spark)
    rows = season.build_season(fx.landed(spark, sf_dir)).play_by_play
    return rows.select("game_id", "number_event", *[f"{role}_player{slot}_id" for role in ("off", "def") for slot in range(1, 6)], *[
        column for role in ("off", "def") for column in (F.array_join(F.col(f"{role}_player_ids").cast("array<string>"), ",", "?").alias(f"{role}_player_ids"),
                                                         F.col(f"{role}_n_players").alias(f"{role}_n_players"))])


# ---- statistics and outputs

@query
def stint_number(spark, sf_dir):
    return event_log(spark, sf_dir).apply(stats.with_stints).frame().select("game_id", "number_event", "stint_home", "stint_away")


@query
def perspective(spark, sf_dir):
    tune(spark)
    log = season.enriched_events(fx.landed(spark, sf_dir))
    return log.apply(stats.perspective).frame().drop("description", "game_date", "season")


@query
def lineup_stats_existing(spark, sf_dir):
    tune(spark)
    return season.existing_stats(season.enriched_events(fx.landed(spark, sf_dir)))


@query
def lineup_stats(spark, sf_dir):
    tune(spark)
    return season.build_season(fx.landed(spark, sf_dir), play_by_play=False).lineup_stats


@query
def lineup_stats_cut(spark, sf_dir):
    """The same with every game of more than 64 events cut into chunks: the path of very large games."""
    tune(spark)
    return season.build_season(fx.landed(spark, sf_dir), max_rows=64, play_by_play=False).lineup_stats


@query
def lineup_index(spark, sf_dir):
    tune(spark)
    return season.build_season(fx.landed(spark, sf_dir), play_by_play=False).lineup_index


@query
def attach_lineup_ids(spark, sf_dir):
    tune(spark)
    return season.build_season(fx.landed(spark, sf_dir)).play_by_play.select(
        "game_id", "number_event", "off_lineup", "def_lineup", "off_lineup_id", "def_lineup_id", "season")


@query
def season_outputs(spark, sf_dir):
    """Published tables: rows and totals by season, and how many rows differ between the CSV and the Parquet files (all columns compared)."""
    tune(spark)
    built = season.build_season(fx.landed(spark, sf_dir))
    names = ("play_by_play", "lineup_index", "lineup_stats")
    outputs = publish.write_season_outputs({name: getattr(built, name) for name in names}, new_path(spark, "outputs"), updated_at=STAMPED_AT)
    counted = []
    value = {"play_by_play": "3 * double(number_event) + double(msg_type)", "lineup_index": "double(lineup_id)", "lineup_stats": "7 * double(pts_team) + double(stint)"}
    for name, paths in outputs.items():
        stored = files.flattened(spark.read.parquet(paths["parquet"]))
        copied = spark.read.option("header", True).schema(stored.schema).csv(paths["csv"])
        differing = ranking.differences(copied, stored).agg(F.count(F.lit(1)).alias("n_differing"))
        sums = files.union_seasons([df.groupBy("season", "_source").agg(
            F.count(F.lit(1)).alias("n_rows"), F.bround(F.sum(F.expr(value[name]))).cast("bigint").alias("total")).select(
            F.lit(name).alias("dataset"), F.lit(fmt).alias("format"), "season", "_source", "n_rows", "total") for fmt, df in {"csv": copied, "parquet": stored}.items()])
        counted.append(sums.join(differing.withColumn("dataset", F.lit(name)), "dataset"))
    return files.union_seasons(counted)


from . import workload_timeline  # noqa: E402, F401  registers its queries
