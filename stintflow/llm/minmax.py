"""Near duplicates by min-max hashing: each permutation gives its minimum and its maximum over a document's shingles.

1. Every document gets its shingle count, an order-free digest of its set, and band keys of four values each. With 24 bands a
   pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^24 = 3e-6.
2. Documents with equal sets are one class; only its smallest document goes on.
3. In every band bucket the members are compared with the bucket's smallest document on full shingle sets; the links found
   give components. The members of buckets that still hold several components then meet on the rare shingles of an exact
   prefix filter, and the pairs left are compared, so no two members of a bucket stay undecided unless they are connected already.
4. Components of all links name each class by the smallest document it reaches.

Defined results: NULL, empty and blank texts have no shingles and are linked with nothing; a text with fewer words than a
shingle has the whole sequence as its only one; rows that share a doc_id are one document; a row without doc_id is linked with nothing and kept.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..sources.shared import stage
from . import flat
from .components import components

WORDS, PERCENT = 5, 80
BANDS, BAND_PERMUTATIONS = 24, 2
SLOTS = 64  # classes of shingles that are counted to bound what two documents can share
_MULTIPLIERS = flat.mixed(np.arange(1, BANDS * BAND_PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(flat.WORD_BASE)) | np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes with their owners in ascending order, and the joint key (owner, hash) of each."""
    low = flat.lowered(data)
    starts, ends = flat.spans(flat.NOT_SPACE[low], bounds)
    owner = flat.text_of(starts, bounds)
    hashes = flat.strings(low, flat.byte_prefix(low), starts, ends)
    first, keys = flat.windows(hashes, owner, words)
    owners = owner[first]
    begins = np.searchsorted(owner, np.arange(len(bounds)))
    short = np.flatnonzero((np.diff(begins) > 0) & (np.diff(begins) < words))
    if len(short):
        whole = flat.taken(flat.prefix(hashes, flat.WORD_BASE), begins[short], begins[short + 1], flat.WORD_BASE)
        owners, keys = np.concatenate([owners, short]), np.concatenate([keys, whole])
    joint = flat.mixed(keys + owners.astype(np.uint64) * np.uint64(flat.WORD_BASE))
    joint, at = np.unique(joint, return_index=True)
    order = np.argsort(owners[at], kind="stable")
    at = at[order]
    return keys[at], owners[at], joint[order]


def _signatures(data: np.ndarray, bounds: np.ndarray, words: int):
    """Per text: set size, two digest halves, band keys."""
    count = len(bounds) - 1
    keys, owners, _ = shingle_sets(data, bounds, words)
    sizes = np.bincount(owners, minlength=count)
    some = np.flatnonzero(sizes)
    one, two = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    bands = np.zeros((count, BANDS), np.uint64)
    if len(some):
        begins = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
        one[some] = np.add.reduceat(flat.mixed(keys), begins)
        two[some] = np.add.reduceat(flat.mixed(keys ^ np.uint64(flat.BASE)), begins)
        for band in range(BANDS):
            joint = np.full(len(some), band + 1, np.uint64)
            for k in range(band * BAND_PERMUTATIONS, (band + 1) * BAND_PERMUTATIONS):
                permuted = keys * _MULTIPLIERS[k]
                for kept in (np.minimum, np.maximum):
                    joint = flat.mixed(joint * np.uint64(flat.BASE) + kept.reduceat(permuted, begins))
            bands[some, band] = joint
    return sizes, one.view(np.int64), two.view(np.int64), bands.view(np.int64)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, digest_a, digest_b, bands`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = flat.utf8(batch.column("text"))
            for a, b in flat.chunks(bounds):
                sizes, one, two, bands = _signatures(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], words)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(one), pa.array(two), lists],
                                                 ["doc_id", "n_shingles", "digest_a", "digest_b", "bands"])
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(flat.released(run), f"doc_id {key}, n_shingles long, digest_a long, digest_b long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets are similar enough. ``texts``: ``doc_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, left_bounds = flat.utf8(batch.column("text_a"))
            right, right_bounds = flat.utf8(batch.column("text_b"))
            good = []
            for i, j in flat.chunks(left_bounds + right_bounds):
                _, own_a, keys_a = shingle_sets(left[left_bounds[i]:left_bounds[j]], left_bounds[i:j + 1] - left_bounds[i], words)
                _, own_b, keys_b = shingle_sets(right[right_bounds[i]:right_bounds[j]], right_bounds[i:j + 1] - right_bounds[i], words)
                shared = np.bincount(own_b[np.isin(keys_b, keys_a, assume_unique=True)], minlength=j - i)
                union = np.bincount(own_a, minlength=j - i) + np.bincount(own_b, minlength=j - i) - shared
                good.append((100 * shared >= percent * union) & (union > 0))
            if good:
                yield batch.select(["a", "b"]).filter(pa.array(np.concatenate(good)))
    key = pairs.schema["a"].dataType.simpleString()
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(flat.released(run), f"a {key}, b {key}")


def _fit(percent: int):
    """A pair whose sizes differ more than this cannot be similar enough."""
    return 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")


def _shingles(texts: DataFrame, words: int) -> DataFrame:
    """``doc_id, part, size, shingle``: a row for each distinct shingle of ``texts(doc_id, text, part)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = flat.utf8(batch.column("text"))
            for a, b in flat.chunks(bounds):
                keys, owners, _ = shingle_sets(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], words)
                sizes = np.bincount(owners, minlength=b - a)
                at = pa.array(owners + a)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("part").take(at), pa.array(sizes[owners]), pa.array(keys.view(np.int64))],
                                                 ["doc_id", "part", "size", "shingle"])
    key = texts.schema["doc_id"].dataType.simpleString()
    return stage(texts.select("doc_id", "text", "part").mapInArrow(flat.released(run), f"doc_id {key}, part {key}, size long, shingle long"))


def _possible(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of documents in different parts that may be similar enough, by an exact prefix filter.

    All shingles have one order: those that never occur in two parts first, then by rising frequency. Two similar documents
    share a shingle among the first ``size - ceil(size * percent / 100) + 1`` of each, so a document whose
    own edits fill that prefix has no partner, and the others meet on their rarest shared shingles only, if
    their counts of shared shingles, class by class, leave room for the similarity.
    """
    shared = rows.groupBy("shingle").agg(F.count("*").alias("often"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").drop("low", "high")
    matched = stage(rows.join(shared, "shingle"))
    own = W.partitionBy("doc_id")
    ranked = matched.withColumn("place", F.row_number().over(own.orderBy("often", "shingle"))).withColumn("matched", F.count("*").over(own))
    length = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    prefix = ranked.where(F.col("place") <= length - (F.col("size") - F.col("matched"))).select("doc_id", "part", "size", "matched", "shingle")
    slots = matched.groupBy("doc_id", F.pmod("shingle", F.lit(SLOTS)).cast("int").alias("slot")).agg(F.count("*").cast("int").alias("n")) \
        .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("n_of")) \
        .select("doc_id", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.coalesce(F.col("n_of")[k], F.lit(0))).alias("slots"))
    prefix = stage(prefix.join(slots, "doc_id"))
    left, right = (prefix.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "part", "size", "matched", "slots")]) for side in "ab")
    # Only shingles that occur in two parts can be shared by a pair, in each slot as many as the poorer of the two has there.
    needed = percent * (F.col("size_a") + F.col("size_b"))
    some = F.least("matched_a", "matched_b") * (100 + percent) >= needed
    enough = F.aggregate(F.zip_with("slots_a", "slots_b", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y) * (100 + percent) >= needed
    return left.join(right, "shingle").where("doc_id_a < doc_id_b AND part_a <> part_b").where(_fit(percent)).where(some).where(enough) \
        .select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    signed = stage(signatures(docs, words))
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    of_set = ["n_shingles", "digest_a", "digest_b"]
    classes = stage(usable.groupBy(*of_set).agg(F.min("doc_id").alias("rep")))
    # A document may appear in several rows; each of its sets stands for it.
    first = usable.join(classes.select(*of_set, F.col("rep").alias("doc_id")), [*of_set, "doc_id"], "left_semi")
    banded = first.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last").drop("last")
    members = stage(banded.join(shared, "band"))

    wanted = members.select("doc_id").distinct()
    texts = stage(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"))
    sizes = members.where("doc_id = centre").select("band", F.col("n_shingles").alias("size_a"))
    stars = (members.where("doc_id <> centre").join(sizes, "band")
             .select(F.col("centre").alias("a"), F.col("doc_id").alias("b"), "size_a", F.col("n_shingles").alias("size_b")).where(_fit(percent))
             .select("a", "b").distinct())
    links = stage(confirmed(stars, texts, words, percent))
    # Rows that share a doc_id are one document: their classes are linked through it.
    same_row = usable.join(classes, of_set).where("doc_id <> rep").select("doc_id", "rep")
    twice = usable.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    joined = same_row.join(twice, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(links.union(joined))

    named = members.join(found.select(F.col("node").alias("doc_id"), "least"), "doc_id", "left") \
        .select("band", "doc_id", F.coalesce("least", "doc_id").alias("part"))
    buckets = named.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("band")
    apart = named.join(buckets, "band").select("doc_id", "part").distinct()
    late = _possible(_shingles(texts.join(apart, "doc_id"), words), percent)
    more = stage(confirmed(late, texts, words, percent))
    if more.take(1):
        found = components(links.union(joined).union(more))

    known = signed.join(classes, of_set, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))
    return known.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "rep").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("least", "rep")).alias("kept"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: rows are told apart by a written number, so of repeated rows, and of
    copies without doc_id, one stays as well. It is the row with the smallest doc_id; one without doc_id stays only if no other has one."""
    # Numbers follow the ids, so that the document that stays is also the one its bucket is compared with; equal ids spread by a further number.
    order = [F.col("doc_id").asc_nulls_last(), F.col("__no")]
    ordered = docs.withColumn("__no", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stage(ordered.withColumn("__row", F.monotonically_increasing_id()).drop("__no"))
    found = near_duplicates(numbered.select(F.col("__row").alias("doc_id"), "text"), words, percent)
    named = numbered.select("__row", "doc_id").join(found.select(F.col("doc_id").alias("__row"), "component_id"), "__row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "__row")).alias("first"))
    return numbered.join(first.select("first.__row"), "__row", "left_semi").select(*docs.columns)
