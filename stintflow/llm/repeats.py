"""Exact substring dedup: bytes inside a string of 100 bytes that also starts earlier in the corpus are removed.

1. Anchors. The anchor of a 100-byte string is the 28-byte string in it with the smallest hash; anchors are about one byte in 37.
   An anchor stands for the snippet of all 100-byte strings that it is the anchor of. Equal snippets of a batch are reduced to the first at once.
2. Anchors meet by hash. Later occurrences of an equal snippet are removed whole; where one anchor has different snippets, the first of each is
   in question.
3. The snippets in question are dealt by anchor and indexed in blocks: a run-length compressed Burrows-Wheeler transform with the ranks and places
   sampled at its run ends, at the ends of snippets and at the intervals of equal 100-byte strings. Each snippet is streamed backwards through the
   index; the matching statistics, bounded by 100, give the interval of each of its 100-byte strings, whose sample is the earliest place in the corpus.
4. An anchor with more than ``GROUP_SNIPPETS`` different snippets is dealt once more, by the 100-byte strings themselves.

Anchors and snippets are told apart by 64 bits each, and the strings in the index by all their bytes.

Defined results: a NULL text is empty; texts under 100 bytes lose nothing; where doc_id is NULL or repeated, rows are taken in order of doc_id
(NULL first) and text, and equal rows one after the other; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.shared import stage
from . import flat

LENGTH, ANCHOR = 100, 28
GROUP_SNIPPETS, BLOCK_BYTES = 20_000, 3 << 19
SEPARATOR = 0xFF  # no byte of UTF-8
_PLACE = np.uint64(0xFFFFFFFF)  # half of a hash that gives way to the place when hashes are compared


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours."""
    out, done = values, 1
    while done * 2 <= size:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:len(out) - (size - done)], out[size - done:]) if done < size else out


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every anchor of a chunk: its text, its hash, bounds in the text of the strings that it stands for, and their hash.

    Of equal hashes the first in a string is its anchor, so the strings of one anchor follow byte by byte.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.view(np.uint64), none, none, none.view(np.uint64)
    sums = flat.byte_prefix(data)
    _, down = flat.powers(flat.BASE, len(sums))
    hashes = flat.mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * down[:len(sums) - ANCHOR])
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    at = (_sliding_least(ranked, LENGTH - ANCHOR + 1) & _PLACE).astype(np.int64)
    inside = np.ones(len(at), bool)
    for bound in bounds[1:-1].tolist():
        inside[max(0, bound - LENGTH + 1):bound] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none.view(np.uint64), none, none, none.view(np.uint64)
    at = at[starts]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.append(first[1:], len(starts)) - 1
    low, high, at = starts[first], starts[last] + LENGTH, at[first]
    owner = flat.text_of(low, bounds)
    prints = flat.mixed(flat.taken(sums, low, high) + (at - low).astype(np.uint64))
    return owner, hashes[at], low - bounds[owner], high - bounds[owner], prints


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First occurrences of snippets in a batch, their bounds in one number; the others as spans, whose number is inverted and thus negative."""
    for batch in batches:
        data, bounds = flat.utf8(batch.column("text"))
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        parts = []
        for a, b in flat.chunks(bounds):
            owner, *rest = anchors(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
            parts.append((keys[a + owner], *rest))
        if not parts:
            continue
        key, anchor, low, high, prints = (np.concatenate(x) for x in zip(*parts))
        joint = flat.mixed(anchor + prints * np.uint64(flat.BASE))
        order = np.lexsort((low, key, joint))
        again = np.zeros(len(order), bool)
        again[1:] = joint[order[1:]] == joint[order[:-1]]
        first, later = order[~again], order[again]
        later = later[np.lexsort((low[later], key[later]))]
        k, lo, hi = key[later], low[later], high[later]
        fresh = np.ones(len(later), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (lo[1:] > hi[:-1])
        at = np.flatnonzero(fresh)
        ends = hi[np.append(at[1:], len(later)) - 1] if len(at) else hi[:0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([anchor[first].view(np.int64), flat.mixed(k[at].astype(np.uint64)).view(np.int64)])),
             pa.array(np.concatenate([prints[first].view(np.int64), np.zeros(len(at), np.int64)])),
             pa.array(np.concatenate([key[first], k[at]])), pa.array(np.concatenate([(low[first] << 32) | high[first], ~((lo[at] << 32) | ends)]))],
            ["anchor", "print", "key", "place"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of anchor, print, key and place: spans to remove, and first occurrences in question (with their anchor)."""
    last, waiting = None, None

    def rows(key, place, anchor=None):
        return key, place >> 32, place & 0xFFFFFFFF, np.zeros(len(key), np.int64) if anchor is None else anchor, np.full(len(key), anchor is not None)
    for batch in batches:
        anchor, prints, key, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        spans = place < 0
        out = [rows(key[spans], ~place[spans])]
        anchor, prints, key, place = (x[~spans] for x in (anchor, prints, key, place))
        if len(anchor):
            group = np.ones(len(anchor), bool)
            group[1:] = anchor[1:] != anchor[:-1]
            fresh = group.copy()
            fresh[1:] |= prints[1:] != prints[:-1]
            if last is not None and anchor[0] == last[0]:
                group[0], fresh[0] = False, prints[0] != last[1]
            number = np.cumsum(group)
            first = np.flatnonzero(fresh)
            kinds = np.bincount(number[first], minlength=number[-1] + 1)
            if kinds[0] and waiting is not None:
                out.append(waiting)
                waiting = None
            many = kinds >= 2
            many[0] = True
            asked = first[many[number[first]]]
            if number[-1] > 0:
                waiting = rows(key[first[-1:]], place[first[-1:]], anchor[first[-1:]]) if kinds[-1] == 1 else None
            out += [rows(key[~fresh], place[~fresh]), rows(key[asked], place[asked], anchor[asked])]
            last = (anchor[-1], prints[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["key", "low", "high", "anchor", "asked"])


class RunIndex:
    """Run-length compressed transform of a text of snippets, each ended by ``SEPARATOR``; ``places`` order all starts in the corpus.

    Rows are the text's suffixes in the order of their first 100 bytes. Those that share 99 or 100 bytes are intervals of rows, and a step
    backwards takes the first row of an interval to the first row of the interval of one byte more.
    """

    def __init__(self, text: np.ndarray, places: np.ndarray):
        self.text, self.size, self.places = text, len(text), places
        rank, _ = self._dense(self._words())
        for width in (8, 24):
            rank, _ = self._three(rank, width)
        order = self._dense(self._pair(rank, LENGTH - 72))[1]
        ahead = np.concatenate([rank, np.zeros(LENGTH, np.uint64)])

        def same(length: int) -> np.ndarray:
            return (rank[order[1:]] == rank[order[:-1]]) & (ahead[order[1:] + length - 72] == ahead[order[:-1] + length - 72])
        self.shorter = self._first_rows(same(LENGTH - 1))
        whole = np.flatnonzero(np.concatenate(([True], ~same(LENGTH))))
        self.earliest = np.zeros(self.size, np.int64)
        self.earliest[whole] = np.minimum.reduceat(places[order], whole)
        self.row_of = np.empty(self.size, np.int64)
        self.row_of[order] = np.arange(self.size)

        before = text[order - 1]
        starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        heads = before[starts].astype(np.int64)
        by_head = np.argsort(heads, kind="stable")
        lengths = np.diff(np.append(starts, self.size))[by_head]
        self.keys, self.starts, self.lengths = heads[by_head] * self.size + starts[by_head], starts[by_head], lengths
        total = np.cumsum(lengths) - lengths
        self.first_of = np.searchsorted(heads[by_head], np.arange(257))
        self.ranks = total - total[self.first_of[heads[by_head]]]
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=256))))

    def _words(self) -> np.ndarray:
        """Eight bytes from each place on as one number."""
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)]).astype(np.uint64)
        words = padded[:self.size].copy()
        for k in range(1, 8):
            words = (words << np.uint64(8)) | padded[k:k + self.size]
        return words

    def _ahead(self, rank: np.ndarray, shift: int) -> np.ndarray:
        out = np.zeros(self.size, np.uint64)
        if shift < self.size:
            out[:self.size - shift] = rank[shift:] + np.uint64(1)
        return out

    def _pair(self, rank: np.ndarray, shift: int) -> np.ndarray:
        return rank * np.uint64(self.size + 1) + self._ahead(rank, shift)

    def _three(self, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of three times the width; for large texts the first two parts are ranked before the third joins."""
        pair = self._pair(rank, width)
        if (self.size + 1) ** 3 >= 1 << 64:
            pair, _ = self._dense(pair)
        return self._dense(pair * np.uint64(self.size + 1) + self._ahead(rank, 2 * width))

    @staticmethod
    def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks without gaps, and the order."""
        order = np.argsort(values)
        ordered = values[order]
        out = np.empty(len(values), np.uint64)
        out[order] = np.cumsum(np.concatenate(([False], ordered[1:] != ordered[:-1])))
        return out, order

    @staticmethod
    def _first_rows(same: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(np.concatenate(([True], ~same)))
        return np.repeat(at, np.diff(np.append(at, len(same) + 1)))

    def rank(self, sign: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each sign before a row."""
        run = np.searchsorted(self.keys, sign * self.size + row) - 1
        return np.where(run >= self.first_of[sign], self.ranks[run] + np.minimum(row - self.starts[run], self.lengths[run]), 0)

    def repeated(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """True at the start of each 100-byte string, of the snippets given, that starts earlier in the corpus as well.

        Each snippet begins with the sampled row of its last 99 bytes and is read backwards; its matches stay 99 bytes long between two steps.
        """
        marks = np.zeros(self.size, bool)
        active = np.argsort(begins - ends, kind="stable")  # long ones first
        begins, at = begins[active], ends[active] - LENGTH
        row = self.shorter[self.row_of[at + 1]]
        while True:
            live = int(np.searchsorted(begins - at, 0, "right"))  # snippets are used up from the short end
            if not live:
                return marks
            begins, at, row = begins[:live], at[:live], row[:live]
            sign = self.text[at].astype(np.int64)
            row = self.below[sign] + self.rank(sign, row)
            marks[at] = self.earliest[row] < self.places[at]
            row = self.shorter[row]
            at = at - 1


def _block_spans(key: np.ndarray, start: np.ndarray, snippets: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removed spans of the snippets of one block."""
    text = np.frombuffer(b"".join(s + bytes([SEPARATOR]) for s in snippets), np.uint8)
    sizes = np.array([len(s) for s in snippets], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    _, ordinal = np.unique(key, return_inverse=True)
    places = np.arange(len(text)) + np.repeat((ordinal << 32) + start - begins, sizes + 1)
    marks = RunIndex(text, places).repeated(begins, begins + sizes)
    low, high = flat.spans(marks, np.append(begins, len(text)))
    owner = flat.text_of(low, begins)
    return key[owner], start[owner] + low - begins[owner], start[owner] + high - begins[owner] + LENGTH - 1


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From snippets in order of anchor, snippet, key and start: spans to remove."""
    names = ["key", "low", "high"]
    keys, starts, snippets, size, last = [], [], [], 0, (None, None)

    def block():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _block_spans(np.array(keys, np.int64), np.array(starts, np.int64), snippets)], names)
    for batch in batches:
        again = ([], [], [])
        for anchor, key, start, snippet in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if (anchor, snippet) == last:
                if (key, start) == (keys[-1], starts[-1]):
                    continue  # the same place, come by another of its anchors
                for values, value in zip(again, (key, start, start + len(snippet))):
                    values.append(value)
                continue
            if anchor != last[0] and size >= BLOCK_BYTES:
                yield block()
                keys, starts, snippets, size = [], [], [], 0
            last = (anchor, snippet)
            keys.append(key)
            starts.append(start)
            snippets.append(snippet)
            size += len(snippet) + 1
        if again[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in again], names)
    if keys:
        yield block()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Snippets of the places in question; around a crowded anchor each 100-byte string by itself, under its own hash."""
    for batch in batches:
        out = ([], [], [], [])
        for key, text, asked in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "asked"))):
            raw = text.encode()
            for each in asked:
                low, high = each["low"], each["high"]
                pieces = [(each["anchor"], low, raw[low:high])]
                if each["crowded"]:
                    pieces = [(int.from_bytes(hashlib.blake2b(raw[k:k + LENGTH], digest_size=8).digest(), "little", signed=True), k, raw[k:k + LENGTH])
                              for k in range(low, high - LENGTH + 1)]
                for values, value in zip(out, zip(*((a, key, lo, s) for a, lo, s in pieces))):
                    values.extend(value)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                                             ["anchor", "key", "start", "snippet"])


def _keyed(docs: DataFrame) -> DataFrame:
    """``key, doc_id, text``: keys are in order of the documents and unique."""
    integral = isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    rows, unique = docs.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if integral and rows == unique:
        return docs.select(F.col("doc_id").cast("long").alias("key"), "doc_id", "text")
    return stage(docs.select("doc_id", "text").sort("doc_id", "text").select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"))


def _removed(docs: DataFrame, group_snippets: int) -> DataFrame:
    """``key, spans`` for documents that lose something; spans may overlap."""
    rows = docs.select("key", "text").mapInArrow(_found, "anchor long, print long, key long, place long")
    met = stage(rows.repartition("anchor").sortWithinPartitions("anchor", "print", "key", "place")
                .mapInArrow(_met, "key long, low long, high long, anchor long, asked boolean"))
    asked = met.where("asked").select("key", "low", "high", "anchor")
    crowded = stage(asked.groupBy("anchor").count().where(F.col("count") > group_snippets).select("anchor", F.lit(True).alias("crowded")))
    asked = asked.join(crowded, "anchor", "left").groupBy("key").agg(F.collect_list(F.struct("low", "high", "anchor", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("asked"))
    # With all columns, so that both joins with the documents read one and the same shuffle of them.
    snippets = docs.join(asked, "key").select("key", "doc_id", "text", "asked").mapInArrow(_cut, "anchor long, key long, start long, snippet binary")
    indexed = snippets.repartition("anchor").sortWithinPartitions("anchor", "snippet", "key", "start").mapInArrow(_indexed, "key long, low long, high long")
    return met.where("NOT asked").select("key", "low", "high").union(indexed).groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        high = min(high, size)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _with_spans(docs: DataFrame, group_snippets: int) -> DataFrame:
    """``doc_id, text, spans`` of every row; spans may overlap, and are NULL where nothing goes."""
    keyed = _keyed(docs.select("doc_id", "text")).where("key IS NOT NULL")
    return keyed.join(_removed(keyed, group_snippets), "key", "left").select("doc_id", "text", "spans")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Bytes and maximal removed runs of each row."""
    for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
        raw = (text.as_py() or "").encode()
        yield raw, merged([(s["low"], s["high"]) for s in spans or []], len(raw))


def removed_spans(docs: DataFrame, group_snippets: int = GROUP_SNIPPETS) -> DataFrame:
    """``doc_id, text, spans`` (start and end in bytes of the maximal removed runs, in order) of every row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches:
            spans = [[{"low": a, "high": b} for a, b in own] for _, own in _runs(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(spans, kind)], ["doc_id", "text", "spans"])
    return _with_spans(docs, group_snippets).mapInArrow(run, f"doc_id {key}, text string, spans array<struct<low:long,high:long>>")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of the bytes that stay."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, spans in _runs(batch):
                edges = [0, *(e for span in spans for e in span), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            n_bytes, n_removed, n_spans, kept = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return _with_spans(docs, GROUP_SNIPPETS).mapInArrow(run, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
