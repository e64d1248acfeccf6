"""Hard negatives by inner products in a residue number system.

Vectors become integers. Their scores are matrix products, taken modulo several small primes in float32: residues lie within half a prime
around zero and are summed over at most ``DEPTH`` components at once, so every partial sum stays below 2**24 and is exact. Chinese remaindering
(mixed radix, in int64) gives the exact signed score back. As many primes are used as twice the largest squared norm needs, which bounds every
score.

1. One pass over the vectors measures dimension and largest norm.
2. Anchors are dealt into passes of ``PASS_BYTES`` of vectors at most, by a hash of the row. A pass ships its anchors to every task and reads
   all rows in blocks: a task keeps the best ``positives`` rows of the anchor's label, and only those leave it.
3. A second reading keeps the best ``negatives`` rows of other labels within the window that each positive's score sets.

What leaves the tasks is at most tasks x anchors x positives x negatives short rows; windows ranked per anchor, which prune before the shuffle, merge them.

Defined results: rows without vec_id, label or vector, or with a NULL or non-finite component, take no part; shorter vectors count as if
filled up with zeros; an anchor without other rows of its label, or a positive without a row in its window, gives no row; rows that share a vec_id
and their score with the anchor count once, an anchor row that occurs repeatedly is one anchor, and rows with the anchor's vec_id are not its
positives; an empty table gives an empty result; further columns are ignored. Scores must fit 52 bits, or the query fails with a message.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.shared import stage
from .ship import ship, unpack

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
DEPTH, LARGEST_PRIME, SCORE_BITS = 256, 509, 52
PASS_BYTES = 16 << 20
ROW_TILE, ANCHOR_TILE = 1024, 256
NOTHING = np.iinfo(np.int64).min


def primes(bound: int) -> list[int]:
    """The largest primes up to ``LARGEST_PRIME`` whose product tells all integers of ``-bound`` to ``bound`` apart."""
    found, product, candidate = [], 1, LARGEST_PRIME
    while product <= 2 * bound + 1:
        if all(candidate % d for d in range(2, int(candidate ** 0.5) + 1)):
            found.append(candidate)
            product *= candidate
        candidate -= 1
    return found


def residues(vectors: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """For each prime the residues nearest to zero, as float32."""
    out = []
    for p in moduli:
        rest = vectors % p
        out.append(np.where(rest > p // 2, rest - p, rest).astype(np.float32))
    return out


def products(left: list[np.ndarray], right: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``left`` with all rows of ``right``, given their residues."""
    value, modulus = None, 1
    for a, b, p in zip(left, right, moduli):
        rest = np.zeros((len(a), len(b)), np.int32)
        for k in range(0, a.shape[1], DEPTH):
            rest += (a[:, k:k + DEPTH] @ b[:, k:k + DEPTH].T).astype(np.int32)
            rest %= p
        if value is None:
            value = rest.astype(np.int64)
        else:
            value += modulus * ((rest - value) * pow(modulus, -1, p) % p)
        modulus *= p
    return np.where(value > modulus // 2, value - modulus, value)


def vectors_of(batch: pa.RecordBatch, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``vec_id``, ``label`` and integer vectors (as float64) of the rows that take part, filled up to ``width`` components."""
    whole = pc.and_(pc.and_(batch.column("vec_id").is_valid(), batch.column("label").is_valid()), batch.column("embedding").is_valid())
    batch = batch.filter(whole)
    lists = batch.column("embedding")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(over="ignore"):
        values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    good = np.bincount(owner[~np.isfinite(values)], minlength=len(sizes)) == 0
    width = int(sizes.max(initial=0)) if width is None else width
    if len(sizes) and (sizes == width).all():
        matrix = values.reshape(len(sizes), width)
    else:
        matrix = np.zeros((len(sizes), width))
        matrix[owner, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
    return ids[good], labels[good], matrix[good]


def measured(rows: DataFrame) -> tuple[int, int]:
    """Number of components and largest squared norm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, matrix = vectors_of(batch)
            with np.errstate(over="ignore"):
                norms = np.square(matrix).sum(axis=1)
            yield pa.RecordBatch.from_pydict({"width": [matrix.shape[1] if len(matrix) else 0], "norm": [float(norms.max(initial=0.0))]})
    found = rows.mapInArrow(run, "width long, norm double").agg(F.max("width"), F.max("norm")).first()
    width, norm = found[0] or 0, found[1] or 0.0
    if norm >= 2.0 ** SCORE_BITS:
        raise ValueError(f"inner products of these vectors can exceed {SCORE_BITS} bits")
    return width, int(norm)


class _Search:
    """One pass: the best rows for each anchor, or for each of its windows (``low`` to ``high``, a column per positive)."""

    def __init__(self, ids, labels, vectors, moduli, kept, same, low=None, high=None):
        self.ids, self.labels, self.moduli, self.kept, self.same = ids, labels, moduli, kept, same
        self.vectors, self.low, self.high = vectors, low, high
        self.windows = 1 if low is None else low.shape[1]
        self.row_tile, self.anchor_tile = ROW_TILE, ANCHOR_TILE

    def begin(self) -> None:
        self.parts = residues(self.vectors, self.moduli)
        shape = (self.windows, len(self.ids), self.kept)
        self.score, self.found = np.full(shape, NOTHING), np.zeros(shape, np.int64)

    def read(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        order = np.lexsort((*matrix.T[:1], labels, ids))
        ids, labels, matrix = ids[order], labels[order], matrix[order]
        while len(ids):  # one turn, unless a vec_id occurs repeatedly
            first = np.ones(len(ids), bool)
            first[1:] = ids[1:] != ids[:-1]
            for a in range(0, int(first.sum()), self.row_tile):
                part = np.flatnonzero(first)[a:a + self.row_tile]
                self._tile(ids[part], labels[part], residues(matrix[part], self.moduli))
            again = ~first
            again[1:] &= ~((labels[1:] == labels[:-1]) & (matrix[1:] == matrix[:-1]).all(axis=1))  # equal rows are one
            ids, labels, matrix = ids[again], labels[again], matrix[again]

    def _tile(self, ids: np.ndarray, labels: np.ndarray, parts: list[np.ndarray]) -> None:
        count = len(ids)
        places = np.arange(count - 1, -1, -1)
        for a in range(0, len(self.ids), self.anchor_tile):
            here = slice(a, a + self.anchor_tile)
            scores = products([p[here] for p in self.parts], parts, self.moduli)
            fits = self.labels[here, None] == labels
            fits = fits & (self.ids[here, None] != ids) if self.same else ~fits
            keys = scores * count + places  # larger for a higher score, then for a smaller vec_id
            for w in range(self.windows):
                fit = fits if self.low is None else fits & (scores >= self.low[here, w, None]) & (scores <= self.high[here, w, None])
                best = np.where(fit, keys, NOTHING)
                if count > self.kept:
                    best = np.partition(best, count - self.kept, axis=1)[:, -self.kept:]
                some = best != NOTHING
                if not some.any():
                    continue
                score = np.where(some, best // count, NOTHING)
                found = np.where(some, ids[count - 1 - np.where(some, best % count, 0)], 0)
                self._merge(w, here, score, found)

    def _merge(self, w: int, here: slice, score: np.ndarray, found: np.ndarray) -> None:
        score, found = np.hstack([self.score[w, here], score]), np.hstack([self.found[w, here], found])
        repeated = True
        while repeated:
            order = np.lexsort((found, ~score), axis=1)  # ~ turns the order around for every integer, NOTHING included
            score, found = np.take_along_axis(score, order, 1), np.take_along_axis(found, order, 1)
            same = (score[:, 1:] == score[:, :-1]) & (found[:, 1:] == found[:, :-1]) & (score[:, 1:] != NOTHING)
            score[:, 1:][same] = NOTHING
            repeated = same.any()
        self.score[w, here], self.found[w, here] = score[:, :self.kept], found[:, :self.kept]


def _searched(rows: DataFrame, search: _Search, width: int) -> DataFrame:
    """``anchor, win, score, vec_id``: what each task keeps; ``anchor`` is the place of the anchor in the pass."""
    shipped = ship(rows.sparkSession.sparkContext, search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = unpack(shipped)
        own.begin()
        for batch in batches:
            own.read(*vectors_of(batch, width))
        win, anchor, _ = at = np.nonzero(own.score != NOTHING)
        yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(win.astype(np.int32)), pa.array(own.score[at]), pa.array(own.found[at])],
                                         ["anchor", "win", "score", "vec_id"])
    return rows.mapInArrow(run, "anchor int, win int, score long, vec_id long")


def _best(found: DataFrame, keys: list[str], kept: int) -> DataFrame:
    """The first ``kept`` different rows of each key with their ``rank``."""
    rank = F.dense_rank().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= kept).distinct()


def _passes(anchors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The anchors, each once, dealt into passes that hold half of ``PASS_BYTES`` on average."""
    anchors = stage(anchors.select("vec_id", "label", "embedding").distinct())
    count = max(1, -(-anchors.count() * (width + 2) * 8 // (PASS_BYTES // 2)))
    return anchors.withColumn("pass", F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(count))), count


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT) -> DataFrame:
    """For each anchor and each of its best ``positives`` rows of its label, the best ``negatives`` rows of other labels whose score is ``low`` to
    ``high`` percent of the positive's. Both tables: ``vec_id, label, embedding``, the anchors among the rows."""
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "embedding")
    width, norm = measured(rows)
    moduli = primes(norm)
    dealt, count = _passes(anchors, width)
    out = None
    for number in range(count):
        batches = dealt.where(F.col("pass") == number).toArrow().to_batches()  # ``PASS_BYTES`` at most
        parts = [vectors_of(b, width) for b in batches] or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width)))]
        ids, labels, vectors = (np.concatenate(x) for x in zip(*parts))
        if not len(ids) and out is not None:
            continue
        near = _best(_searched(rows, _Search(ids, labels, vectors, moduli, positives, True), width), ["anchor"], positives)
        near = stage(near.select("anchor", (F.col("rank") - 1).alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
        found = near.toArrow()  # ``positives`` short rows for each anchor of the pass
        at = (found["anchor"].to_numpy(), found["win"].to_numpy())
        bottom, top = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)  # no row lies in 1 to 0
        score = found["positive_score"].to_numpy()
        bottom[at], top[at] = -(-low * score // 100), high * score // 100
        far = _best(_searched(rows, _Search(ids, labels, vectors, moduli, negatives, False, bottom, top), width), ["anchor", "win"], negatives)
        named = spark.createDataFrame(pa.table({"anchor": np.arange(len(ids), dtype=np.int32), "anchor_id": ids}), "anchor int, anchor_id long")
        mined = far.join(near, ["anchor", "win"]).join(named, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        mined = stage(mined) if count > 1 else mined
        out = mined if out is None else out.unionByName(mined)
    return out


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Wrong labels, planted where ``every`` divides the vec_id."""
    label = F.col("label").cast("long")
    return rows.select("vec_id", F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label).alias("label"), "embedding")


def chosen(rows: DataFrame, every: int = 50) -> DataFrame:
    """The rows that are anchors."""
    return rows.where(F.col("vec_id") % every == 0)


STATEMENT = f"""
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND {LOW_PERCENT} * positive_score <= 100 * score AND 100 * score <= {HIGH_PERCENT} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= {NEGATIVES}"""
