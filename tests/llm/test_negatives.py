import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintflow.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score string, anchor string, win string, rank string, positive_id string"


def brute(rows, every=50, positives=5, count=3):
    """The contract's text, one pair at a time; rows (vec_id, label, embedding) with labels as they are to be compared."""
    def whole(row):
        return None not in row and all(x is not None and math.isfinite(x) for x in row[2])
    usable = sorted({(i, k, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, k, v in filter(whole, rows)})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, label, v in usable:
        if i % every:
            continue
        scored = [(j, k, dot(v, w)) for j, k, w in usable]
        near = sorted({(-s, j) for j, k, s in scored if k == label and j != i})[:positives]
        for s, j in near:
            far = sorted({(-t, m) for m, k, t in scored if k != label and 50 * -s <= 100 * t <= 95 * -s})[:count]
            out |= {(i, j, r, m, -s, -t) for r, (t, m) in enumerate(far, 1)}
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in negatives.mine(df, negatives.chosen(df), **options).collect())


def sample(count, width, seed=3, labels=3):
    pick = random.Random(seed)
    hot = [pick.uniform(-1, 1) for _ in range(width)]
    return [(k, pick.randrange(labels), hot if k % 3 == 0 else [pick.uniform(-1, 1) + (k % 5) / 4 for _ in range(width)]) for k in range(count)]


@pytest.mark.parametrize("width", [1, 7, 64, 300])
def test_against_pairs(spark, width):
    rows = sample(400, width)
    assert mined(spark, rows) == brute(rows) != []


def test_unusable_rows_and_repeats(spark):
    rows = sample(160, 4)
    rows += [(None, 1, [1.0] * 4), (200, None, [1.0] * 4), (250, 1, None), (300, 1, [1.0, None, 1.0, 1.0]), (350, 1, [1.0, math.nan, 0.0, 0.0]), (400, 1, [math.inf, 0.0, 0.0, 0.0]),
             (450, 1, []), (500, 1, [0.5, 0.5])]
    rows += rows[:60] * 3 + [(50, 2, [0.25, 0.5, 0.75, 1.0]), (3, 1, [0.5, 0.5, 0.5, 0.5]), (3, 0, [0.5, 0.5, 0.5, 0.5])] * 2
    assert mined(spark, rows) == brute(rows) != []
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == mined(spark, [(50, 1, [1.0])]) == []


def test_small_tiles_and_passes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_TILE", 7)
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 2)
    monkeypatch.setattr(negatives, "PASS_BYTES", 300)
    rows = sample(300, 5, seed=8)
    assert mined(spark, rows) == brute(rows) != []


def test_products_are_exact():
    pick = np.random.default_rng(5)
    for width, size in ((1, 1), (64, 300), (700, 4_000), (257, 60_000)):
        a, b = (pick.integers(-size, size + 1, (9, width)) for _ in range(2))
        a[0] = b[0] = size
        a[1] = -size
        bound = width * size * size
        moduli = negatives.primes(bound)
        assert negatives.products(negatives.residues(a, moduli), negatives.residues(b, moduli), moduli).tolist() == (a.astype(object) @ b.T.astype(object)).tolist()


def test_scores_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError, match="52 bits"):
        mined(spark, [(50, 1, [1e9] * 3)])


def test_labels_are_planted(spark):
    df = spark.createDataFrame([(7, 9, [1.0]), (14, None, [1.0]), (8, 9, [1.0]), (None, 3, [1.0]), (21, 2147483647, [1.0])], "vec_id long, label int, embedding array<float>")
    assert [r.label for r in negatives.relabelled(df).collect()] == [0, None, 9, 3, 8]
    assert df.where(F.col("vec_id") % 50 == 0).count() == 0
