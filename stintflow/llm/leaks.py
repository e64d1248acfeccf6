"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark items. For each pattern length a shift table over blocks of three words tells how far a
window may move on: a block that no pattern holds lets it pass over the whole block span. A shift of zero means that the
block ends some pattern; the bucket of that suffix is searched for the window's hash, and the words are compared in full.
Texts are cut into stripes whose windows move on together, each by its own shifts.

Defined results: a NULL or empty text has no words; items without an id or without words are no patterns; equal items are
all reported; an empty benchmark leaves every document clean; repeated rows are searched one by one.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.shared import stage
from . import flat
from .ship import ship, unpack

WINDOW_WORDS, BLOCK_WORDS, STRIPE_WORDS = 10, 3, 256
# Benchmark text that is searched for in one pass; a larger benchmark is dealt with in several passes over the documents.
PASS_BYTES = 16 << 20

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True


def words_of(data: np.ndarray, bounds: np.ndarray):
    """Lower-cased bytes, word starts, ends, owners and hashes."""
    low = flat.lowered(data)
    starts, ends = flat.spans(WORD_BYTE[low], bounds)
    return low, starts, ends, flat.text_of(starts, bounds), flat.taken(flat.byte_prefix(low), starts, ends)


class Patterns:
    """Shift table and suffix buckets of all patterns with the same number of words."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.items = {b" ".join(w): sorted(ids) for w, ids in windows.items()}
        texts = list(self.items)
        joined = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        _, _, _, owner, hashes = words_of(joined, bounds)
        _, whole = flat.windows(hashes, owner, length)
        first, blocks = flat.windows(hashes, owner, self.block)
        shift = length - self.block - first % length
        order = np.lexsort((shift, blocks))
        self.blocks, at = np.unique(blocks[order], return_index=True)
        self.shifts = shift[order][at]
        bucket_order = np.lexsort((whole, blocks[shift == 0]))
        self.suffix, self.whole = blocks[shift == 0][bucket_order], whole[bucket_order]
        self.bucket_keys = np.sort(flat.mixed(self.suffix ^ self.whole * np.uint64(flat.BASE)))

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """First words of the windows whose suffix bucket holds their hash."""
        first, whole = flat.windows(hashes, owner, self.length)
        if not len(first):
            return first
        _, blocks = flat.windows(hashes, np.zeros(len(hashes), np.int64), self.block)
        stripes = np.arange(0, len(first), STRIPE_WORDS)
        limit = np.minimum(stripes + STRIPE_WORDS, len(first))
        at, found, texts = stripes, [], owner[first]
        while len(at):
            suffix = blocks[first[at] + self.length - self.block]
            slot = np.minimum(np.searchsorted(self.blocks, suffix), len(self.blocks) - 1)
            shift = np.where(self.blocks[slot] == suffix, self.shifts[slot], self.length - self.block + 1)
            zero = shift == 0
            if zero.any():
                key = flat.mixed(suffix[zero] ^ whole[at[zero]] * np.uint64(flat.BASE))
                place = np.minimum(np.searchsorted(self.bucket_keys, key), len(self.bucket_keys) - 1)
                found.append(first[at[zero][self.bucket_keys[place] == key]])
            # A shift ends at the first window of the next text: it says nothing about that.
            moved = at + np.maximum(shift, 1)
            left = (shift > 1) & (texts[np.minimum(moved, len(first) - 1)] != texts[at])
            if left.any():
                moved[left] = np.minimum(moved[left], np.searchsorted(texts, texts[at[left]], "right"))
            alive = moved < limit
            at, limit = moved[alive], limit[alive]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def item_windows(texts: list[tuple[str, str]]) -> list[Patterns]:
    """Patterns by length from (item id, text) rows."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        low, starts, ends, _, _ = words_of(raw, np.array([0, len(raw)]))
        words = [low[a:b].tobytes() for a, b in zip(starts, ends)]
        length = min(WINDOW_WORDS, len(words))
        for k in range(len(words) - length + 1 if words else 0):
            by_length[length][tuple(words[k:k + length])].add(item)
    return [Patterns(length, dict(found)) for length, found in sorted(by_length.items())]


def search(column: pa.Array, patterns: list[Patterns]) -> tuple[list[int], list[list[int]], list[list[str]]]:
    """For every text: number of words, places of the words inside an occurrence, items found."""
    n_words, hits, items = [], [], []
    data, bounds = flat.utf8(column)
    for a, b in flat.chunks(bounds):
        low, starts, ends, owner, hashes = words_of(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
        begins = np.searchsorted(owner, np.arange(b - a + 1))
        marked = np.zeros(len(hashes), bool)
        seen: list[set[str]] = [set() for _ in range(b - a)]
        for p in patterns:
            for k in p.candidates(hashes, owner).tolist():
                said = b" ".join([low[starts[j]:ends[j]].tobytes() for j in range(k, k + p.length)])
                if said in p.items:
                    marked[k:k + p.length] = True
                    seen[owner[k]].update(p.items[said])
        n_words += np.diff(begins).tolist()
        items += [sorted(s) for s in seen]
        hits += [np.flatnonzero(marked[begins[i]:begins[i + 1]]).tolist() for i in range(b - a)]
    return n_words, hits, items


def benchmark_passes(spark: SparkSession, benchmark: DataFrame) -> Iterator[list[Patterns]]:
    """Patterns of the benchmark, as many lists as the size of its text asks for."""
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // PASS_BYTES)
    for k in range(passes):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        yield item_windows([(r.item_id, r.text) for r in part.collect()])


def occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows with their columns, and ``leak_words``, ``leak_hits`` (places of hit words), ``leak_items``."""
    spark = docs.sparkSession
    extra = "leak_words long, leak_hits array<int>, leak_items array<string>"
    out = docs.selectExpr("*", *(f"CAST(NULL AS {part.split()[1]}) AS {part.split()[0]}" for part in extra.split(", ")))

    def passed(shipped):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = unpack(shipped) if shipped is not None else []
            for batch in batches:
                if not batch.num_rows:
                    continue
                n, hits, items = search(batch.column("text"), patterns)
                old_hits, old_items = batch.column("leak_hits").to_pylist(), batch.column("leak_items").to_pylist()
                hits = [sorted({*h, *(o or [])}) for h, o in zip(hits, old_hits)]
                items = [sorted({*i, *(o or [])}) for i, o in zip(items, old_items)]
                found = [pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *found], batch.schema.names)
        return run

    done = 0
    for patterns in benchmark_passes(spark, benchmark):
        out = (stage(out) if done else out).mapInArrow(flat.released(passed(ship(spark.sparkContext, patterns))), out.schema)
        done += 1
    return out if done else out.mapInArrow(flat.released(passed(None)), out.schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found and the digest of their ids."""
    found = occurrences(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.col("leak_words").alias("n_words"), F.size("leak_hits").cast("long").alias("n_hit"),
                        F.size("leak_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"),
                        (F.size("leak_hits") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any occurrence, with all their columns."""
    spark, out, done = docs.sparkSession, docs, 0

    def passed(shipped):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = unpack(shipped)
            for batch in batches:
                if batch.num_rows:
                    yield batch.filter(pa.array([not i for i in search(batch.column("text"), patterns)[2]]))
        return run

    for patterns in benchmark_passes(spark, benchmark):
        out = (stage(out) if done else out).mapInArrow(flat.released(passed(ship(spark.sparkContext, patterns))), docs.schema)
        done += 1
    return out


# The search in SQL, on the tables ``documents`` and ``benchmark``: every window of every document joined with the items' windows.
STATEMENT = r'''WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
spots AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM patterns))),
hits AS (SELECT r, spots.n, i, item FROM spots JOIN patterns USING (n, g)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)'''
