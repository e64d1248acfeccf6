"""Packing by Karmarkar-Karp multiway differencing.

A document longer than the capacity gives full windows of its own; what is left of it, like a shorter document, is one piece, whose last
``TAILS`` tokens (a number drawn from its own ids) are cut off as a second: a few small pieces let the windows even out. Pieces are dealt by a written
number into parts of about ``WINDOWS`` windows, however many copies or empty texts there are, and each part is one task:

* A partition of k windows starts from each piece alone. The two partitions with the largest differences between fullest and emptiest window
  are merged, the fullest windows of one with the emptiest of the other, until one is left; then all windows are nearly equal.
* k begins at the fewest windows that could hold the part, and rises whenever a window of the result exceeds the capacity.

Pieces below ``SMALL`` tokens are bundled first, so that a part of empty texts is as cheap as others. About 0.2 % of the places stay empty.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed one by one; an empty table gives an empty result; further columns are ignored.
"""
from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import stage
from .tokens import Encoder, distinct_texts, vocabulary_path

CAPACITY, END_ID = 2048, 1
TAILS = (8, 128)
WINDOWS = 512
SMALL, BUNDLE = 8, 16


def cut(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and end of each piece."""
    full = len(ids) // capacity * capacity
    out = [(a, a + capacity) for a in range(0, full, capacity)]
    if full < len(ids):
        least, most = TAILS
        tail = int(least * (most / least) ** (zlib.crc32(ids.tobytes()) / 2 ** 32))
        edge = len(ids) - tail if len(ids) - full > 2 * tail else full
        out += [(a, b) for a, b in ((full, edge), (edge, len(ids))) if a < b]
    return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every row."""
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            code, texts = distinct_texts(batch.column("text"))
            parts = []
            for text in texts:
                ids = np.append(encoder.ids(text.as_py()), end_id).astype("<u4")
                parts.append([(a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids)) for a, b in cut(ids, capacity)])
            rows = [(r, *p) for r, c in enumerate(code.tolist()) for p in parts[c]]
            at, *found = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *map(pa.array, found)], ["doc_id", *names])
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, " + ", ".join(f"{n} long" for n in names))


def difference(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each piece, and the sum of each window.

    A partition lists its windows that are not empty, fullest first; its difference is that of the fullest and the emptiest.
    """
    heap = [(-size, k, np.array([size], np.int64), None) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        (_, i, one, past_one), (_, j, two, past_two) = heapq.heappop(heap), heapq.heappop(heap)
        sums = np.zeros(min(windows, len(one) + len(two)), np.int64)
        sums[:len(one)] = one
        sums[::-1][:len(two)] += two  # the fullest meets the emptiest
        order = np.argsort(-sums, kind="stable").astype(np.int16 if windows < 1 << 15 else np.int32)
        sums = sums[order]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (-int(sums[0] - least), number, sums, (order, (i, len(one), past_one), (j, len(two), past_two))))
        number += 1
    if not heap:
        return np.zeros(0, np.int64), np.zeros(windows, np.int64)
    _, last, sums, past = heap[0]
    out, open_ = np.zeros(len(sizes), np.int64), [(last, past, np.arange(len(sums)))]
    while open_:
        number, past, own = open_.pop()
        if past is None:
            out[number] = own[0]
            continue
        order, (i, count_one, past_one), (j, count_two, past_two) = past
        place = np.empty(len(order), np.int64)
        place[order] = own
        open_ += [(i, past_one, place[:count_one]), (j, past_two, place[::-1][:count_two])]
    return out, np.concatenate([sums, np.zeros(windows - len(sums), np.int64)])


def bundles(sizes: np.ndarray) -> np.ndarray:
    """Number of the item of each piece: small pieces share one."""
    small = sizes < SMALL
    out = np.empty(len(sizes), np.int64)
    together = (np.cumsum(sizes[small]) - sizes[small]) // BUNDLE
    shared = int(together[-1]) + 1 if len(together) else 0
    out[small] = together
    out[~small] = shared + np.arange(int((~small).sum()))
    return np.unique(out, return_inverse=True)[1] if len(out) else out


def windows_of(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each piece, none fuller than the capacity."""
    item = bundles(sizes)
    totals = np.bincount(item, weights=sizes).astype(np.int64)
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found, sums = difference(totals.tolist(), count)
        over = int(np.maximum(sums - capacity, 0).sum())
        if not over:
            return found[item]
        count += max(1, over // capacity)


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cuts`` (from ``pieces``) with ``sequence_id`` and ``offset``."""
    numbered = stage(cuts.withColumn("__row", F.monotonically_increasing_id()))
    full = F.col("length") == capacity
    open_ = numbered.where(~full)
    tokens = open_.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-tokens // (WINDOWS * capacity)))
    names = cuts.columns

    def run(_, part):
        part = part.sort_by([("length", "descending"), ("__row", "ascending")])
        sizes = part["length"].to_numpy()
        window = windows_of(sizes, capacity)
        order = np.argsort(window, kind="stable")
        inside = np.cumsum(sizes[order]) - sizes[order]
        first = np.flatnonzero(np.diff(window[order], prepend=-1))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = inside - np.repeat(inside[first], np.diff(np.append(first, len(sizes))))
        columns = [part[n] for n in names] + [pa.array((part["__part"].to_numpy().astype(np.int64) << 32) + window), pa.array(offset)]
        return pa.table(columns, [*names, "sequence_id", "offset"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cuts.schema.fields)
    dealt = open_.withColumn("__part", F.pmod(F.xxhash64("__row"), F.lit(parts)))
    windows = dealt.groupBy("__part").applyInArrow(run, f"{fields}, sequence_id long, offset long")
    alone = numbered.where(full).select(*names, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return alone.unionByName(windows)


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(pieces(docs, path or vocabulary_path(), capacity, end_id), capacity)
