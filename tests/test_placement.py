"""Logs stored by game: later steps read them without an exchange, and nothing of them outlives ``clear_stages``."""
import pytest

from stintflow import fixtures as fx
from stintflow.operators.scan import CHUNK, order_chunk, row_count, scan, split_large_groups
from stintflow.plans import events as ev, season, stats
from stintflow.sources.shared import clear_stages, session_folder, stage_by

from .conftest import rows


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def above_scans(df, needed):
    """For every scan that reads the column ``needed``: the plan lines above it, up to the root."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-*(0123456789)")) for line in lines]
    found = []
    for at, line in enumerate(lines):
        if "Scan" in line and needed in line:
            above, level = [], depth[at]
            for k in range(at - 1, -1, -1):
                if depth[k] < level:
                    above.append(lines[k])
                    level = depth[k]
            found.append(above)
    return found


def exchanges(df, needed):
    return [sum("Exchange" in line for line in above) for above in above_scans(df, needed)]


def test_ids_are_attached_without_an_exchange_of_the_events(spark, small, no_broadcast):
    tables = fx.landed(spark, small)
    log = season.enriched_events(tables).stored_by("game_id")
    existing = season.existing_stats(log)
    members = stats.lineup_members(existing, tables.player_logs, stats.lineup_index(existing))
    placed = log.apply(stats.attach_lineup_ids, members).frame()
    assert exchanges(placed, "act_type") == [0]
    staged = log.stage().apply(stats.attach_lineup_ids, members).frame()  # not stored by game: partitioned once for both joins
    assert exchanges(staged, "act_type") == [1]
    assert rows(placed) == rows(staged)


def test_stints_are_summed_without_an_exchange_of_the_events(spark, small, no_broadcast):
    log = season.enriched_events(fx.landed(spark, small)).stored_by("game_id")
    assert set(exchanges(season.existing_stats(log), "lineup_home")) == {0}


def test_enrichment_has_no_exchange_of_the_stored_events(spark, small, no_broadcast):
    enriched = season.enriched_events(fx.landed(spark, small)).frame()
    assert exchanges(enriched, "act_type") == [0]


def test_a_bucket_is_one_file_of_a_log_computed_by_game(spark, small):
    log = ev.sequence_events(fx.feed(spark, small), fx.player_logs(spark, small)).stored_by("game_id")
    assert len(log.frame().inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_large_groups_are_stored_by_chunk_and_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)] + [(2, n) for n in range(30)], "game_id INT, n INT")
    log = split_large_groups(df, ["game_id"], order_chunk(number="n", rows=4), 10).stored_by("game_id")
    assert [CHUNK in part.columns for part in log.parts] == [False, True]
    got = rows(log.apply(scan, ["game_id"], ["n"], {"row": row_count()}).frame(), "game_id", "n", "row")
    assert got == sorted([(None, 1, 1), (None, 2, 2), (1, 1, 1)] + [(2, n, n + 1) for n in range(30)], key=repr)


def test_empty_logs_are_stored(spark):
    stored = stage_by(spark.createDataFrame([], "game_id INT, n INT"), "game_id")
    assert stored.columns == ["game_id", "n"] and stored.collect() == []


def test_clearing_drops_the_stored_tables(spark):
    other = spark.newSession()
    stage_by(other.range(5).withColumnRenamed("id", "game_id"), "game_id")
    assert any(table.name.startswith("staged_") for table in other.catalog.listTables())
    clear_stages(other)
    assert not any(table.name.startswith("staged_") for table in spark.catalog.listTables())
    path = spark._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_tasks_of_a_log_follow_its_rows(spark, monkeypatch):
    """A task keeps a sort of its rows for every scan, so the rows of a task are bounded, not the number of tasks."""
    from stintflow.operators import scan as scans
    monkeypatch.setattr(scans, "ROWS_PER_TASK", 50)
    df = spark.range(3000).selectExpr("CAST(id % 300 AS INT) AS game_id", "CAST(id AS INT) AS n")
    log = split_large_groups(df, ["game_id"], order_chunk(number="n"), 1000)
    assert log.frame().rdd.getNumPartitions() == 60
    log = log.stored_by("game_id").apply(scan, ["game_id"], ["n"], {"row": row_count()})
    assert log.frame().rdd.getNumPartitions() == 60
    assert log.frame().where("row > 10").count() == 0
