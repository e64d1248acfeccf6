"""Best-fit packing planned on length counts, documents taking their slots by rank within their length.

A document longer than the capacity is cut into full pieces behind a first, shorter one. The plan is best-fit decreasing over the number of
pieces of each length: at most ``capacity`` lengths reach the driver and the plan has at most a few ranges of slots per length
and free space, whatever the number of documents. Pieces are ranked within their length in salted blocks, so that no length meets in one
task, and each takes the slot of its rank.

Defined results: a NULL text is empty and becomes the end id alone; repeated rows are packed one by one.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..sources.shared import stage
from . import flat
from .tokens import Encoder, distinct_texts, vocabulary_path

CAPACITY, END_ID = 1024, 2
RANKED_TOGETHER = 1 << 16


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of each piece."""
    first = length if length <= capacity else length % capacity or capacity
    edges = [0, first, *range(first + capacity, length + 1, capacity)]
    return list(zip(edges[:-1], edges[1:]))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every row."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            code, texts = distinct_texts(batch.column("text"))
            parts = []
            for text in texts:
                ids = np.append(encoder.ids(text.as_py()), end_id).astype("<u4")
                parts.append([(a, b - a, zlib.crc32(ids[a:b].tobytes())) for a, b in cut(len(ids), capacity)])
            rows = [(r, k, *p) for r, c in enumerate(code.tolist()) for k, p in enumerate(parts[c])]
            at, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start),
                                              pa.array(length), pa.array(crc)], names)
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(flat.released(run), f"doc_id {key}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Slots as rows (length, first rank, first sequence, offset, sequences), in order of length and rank; number of sequences.

    The slots of one row are consecutive ranks on consecutive sequences.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # ranges (first sequence, number) by space left
    slots, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for space in range(length, capacity + 1):
            each = space // length
            while left and (free[space] or space == capacity):
                if space == capacity:
                    first, number = opened, -(-left // each)
                    opened += number
                else:
                    first, number = free[space].pop()
                filled = min(number, left // each)
                for k in range(each):
                    if filled:
                        slots.append((length, rank, first, capacity - space + k * length, filled))
                        rank += filled
                left -= filled * each
                if filled:
                    free[space - each * length].append((first, filled))
                if filled < number and left and left < each:
                    for k in range(left):
                        slots.append((length, rank, first + filled, capacity - space + k * length, 1))
                        rank += 1
                    free[space - left * length].append((first + filled, 1))
                    left, filled = 0, filled + 1
                if filled < number:
                    free[space].append((first + filled, number - filled))
                    break
            if not left:
                break
    ordered = sorted(slots)
    return np.array(ordered, np.int64).reshape(-1, 5), opened


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cuts`` (with columns ``doc_id, piece, start, length, ids_crc32``) with ``sequence_id`` and ``offset``."""
    spark = cuts.sparkSession
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots, _ = plan(counts, capacity)
    shared = spark.sparkContext.broadcast(slots)
    salts = F.array(*[F.lit(-(-counts.get(n, 1) // RANKED_TOGETHER)) for n in range(capacity + 1)])
    salted = cuts.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(salts, F.col("length").cast("int") + 1)))
    sizes = salted.groupBy("length", "block").count()
    before = sizes.select("length", "block", (F.sum("count").over(W.partitionBy("length").orderBy("block")) - F.col("count")).alias("before"))
    order = W.partitionBy("length", "block").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("place", F.row_number().over(order) - 1).join(before, ["length", "block"]) \
        .select(*cuts.columns, (F.col("before") + F.col("place")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table[:, 0] << 44) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            slot = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            sequence = slot[:, 2] + rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(slot[:, 3])],
                                             [*batch.schema.names[:-1], "sequence_id", "offset"])
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cuts.schema.fields)
    return ranked.mapInArrow(flat.released(run), f"{names}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(stage(pieces(docs, path or vocabulary_path(), capacity, end_id)), capacity)
