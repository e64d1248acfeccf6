"""Running score of games from a stream of events, in event order although files arrive out of order.

Games are kept in blocks of neighbouring ids. The state of a game is its score so far and the events that the watermark has not passed yet: at most those of ``delay``. Once the watermark passes
an event, it is emitted with the score; an event that arrives at or behind the watermark is dropped, as the watermark says. A row of ``close`` (a game that
never ends, far in the future) moves the watermark over everything at the end of a feed.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "game_id long, number_event long, ts timestamp, home int, away int"
SCORED = "game_id long, number_event long, ts timestamp, hs long, vs long"
_STATE = "scores array<struct<game_id:long,hs:long,vs:long>>, waiting array<struct<game_id:long,ts:long,number_event:long,home:int,away:int>>"
GAMES_PER_STATE = 64  # a call into Python costs about as much as some hundred events, so neighbouring games share one
CLOSING_GAME = -1


def advance(score: tuple[int, int], waiting: list[tuple], until: int) -> tuple[tuple[int, int], list[tuple], list[tuple]]:
    """Score, events still waiting, and emitted rows once all events up to ``until`` (microseconds) are known."""
    hs, vs = score
    ready = sorted(row for row in waiting if row[0] <= until)
    out = []
    for ts, number, home, away in ready:
        hs, vs = hs + home, vs + away
        out.append((number, ts, hs, vs))
    return (hs, vs), [row for row in waiting if row[0] > until], out


def _score(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    scores, waiting = state.get if state.exists else ([], [])
    scores, games = {game: (hs, vs) for game, hs, vs in scores}, defaultdict(list)
    for game, *row in waiting:
        games[game].append(tuple(row))
    for batch in batches:
        stamps = batch["ts"].astype("datetime64[us]").astype("int64")
        ids = batch["game_id"].astype("Int64").astype(object).where(batch["game_id"].notna(), None)
        for game, *row in zip(ids.tolist(), stamps.tolist(), batch["number_event"].tolist(), batch["home"].tolist(), batch["away"].tolist()):
            games[game].append(tuple(row))
    until = state.getCurrentWatermarkMs() * 1000
    waiting, out = [], []
    for game, rows in games.items():
        scores[game], left, scored = advance(scores.get(game, (0, 0)), rows, until)
        waiting += [(game, *row) for row in left]
        out += [(game, *row) for row in scored]
    state.update(([(game, hs, vs) for game, (hs, vs) in scores.items()], waiting))
    if waiting:
        state.setTimeoutTimestamp(max(min(row[1] for row in waiting) // 1000, until // 1000 + 1))
    if out:
        game, number, ts, home, away = zip(*out)
        yield pd.DataFrame({"game_id": pd.array(game, dtype="Int64"), "number_event": number, "ts": pd.to_datetime(list(ts), unit="us"), "hs": home, "vs": away})


def running_score(events: DataFrame, delay: str) -> DataFrame:
    """Stream of ``EVENTS`` to a stream of ``SCORED``, in append mode."""
    blocks = events.withColumn("block", F.floor(F.col("game_id") / GAMES_PER_STATE))
    return blocks.withWatermark("ts", delay).groupBy("block").applyInPandasWithState(
        _score, SCORED, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def read_events(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """Event files of a folder as a stream, oldest first, at most ``files`` at a time."""
    reader = spark.readStream.schema(EVENTS)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def run(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has landed and stop; started again with the same checkpoint it goes on where it stopped."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(target).awaitTermination()
