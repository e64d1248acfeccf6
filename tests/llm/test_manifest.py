import random
import zlib
from hashlib import sha256

import pytest

from stintflow.llm import manifest

from . import cases


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    said = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return H(*map(said, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def climb(levels, place):
    """Others of the run at each level, with the digest's place in it."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[place // 2 * 2:place // 2 * 2 + 2]
        out.append((place % 2, run[1 - place % 2] if len(run) == 2 else None))
        place //= 2
    return out


def brute(rows):
    """One tree after the other, each proof walked on its own."""
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, text, lang, source, n_chars)
        wrong = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, leaf_of(doc_id, text, lang, source, n_chars + 1) if wrong else leaf))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: tree([leaf for _, _, leaf, _, _ in sorted(trees[lang])]) for lang in order}
    top = tree([built[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for place, (_, _, leaf, doc_id, claim) in enumerate(sorted(trees[lang])):
            steps = climb(built[lang], place) + climb(top, at)
            folded = claim
            for right, other in steps:
                folded = H(folded) if other is None else H(other, folded) if right else H(folded, other)
            siblings = [other for _, other in steps if other is not None]
            out.append((doc_id, leaf, built[lang][-1][0], top[-1][0], H(*siblings), folded, folded == top[-1][0], siblings))
    return sorted(out, key=repr)


def proved(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    df = df.selectExpr("*", "'x' AS tree", "'x' AS place", "'x' AS leaves", "'x' AS leaf", "'x' AS digest", "'x' AS span", "'x' AS claimed")
    return sorted((tuple(r) for r in manifest.proofs(manifest.leaves_of(df, manifest.tampered())).collect()), key=repr)


def sample(count, langs, seed=1):
    pick = random.Random(seed)
    return [(k, pick.choice([None, "", "aé\n", "x" * pick.randrange(50)]), pick.choice(langs), pick.choice(["s", None]), pick.choice([None, 0, 5, 123456])) for k in range(count)]


@pytest.mark.parametrize("levels, span, handed", [(10, 5, 1024), (1, 1, 2), (2, 3, 1), (3, 2, 2)])
def test_against_whole_trees(spark, monkeypatch, levels, span, handed):
    for name, value in (("LEVELS", levels), ("SPAN", span), ("HANDED", handed)):
        monkeypatch.setattr(manifest, name, value)
    rows = sample(333, ["en"] * 6 + ["de", None, "", "é", "Z"]) + [(1, "x", "one", "s", 2)]
    assert proved(spark, rows) == brute(rows)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 16, 17])
def test_small_trees(spark, monkeypatch, count):
    monkeypatch.setattr(manifest, "LEVELS", 2)
    rows = sample(count, ["en"])
    assert proved(spark, rows) == brute(rows)


def test_repeats_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", 1)
    rows = [(None, None, None, None, None), (None, "a", None, None, 9223372036854775807)] * 3 + [(7, "same", "en", "s", 4)] * 20 + [(7, "other", "en", "s", 9223372036854775807)] * 2 + sample(9, ["en"])
    assert proved(spark, rows) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in docs.collect()]
    found = brute(rows)
    assert proved(spark, rows) == found
    assert 0 < sum(not r[6] for r in found) < len(found)


def test_multiproof_asks_for_nothing_it_can_derive():
    for leaves in (1, 2, 5, 37):
        levels = tree([H(str(k)) for k in range(leaves)])
        for first in range(leaves):
            for last in range(first, leaves):
                wanted = manifest.missing(range(first, last + 1), leaves)
                fetched = {(at, place): levels[at][place] for at, place in wanted}
                derived = manifest.derive(first, levels[0][first:last + 1], leaves, dict(fetched))
                assert derived[-1][1] == levels[-1]
                assert len(wanted) <= 2 * len(levels) and len(set(wanted)) == len(wanted)
                for at, place in wanted:  # none of them lies above a known leaf
                    assert all(k >> at != place for k in range(first, last + 1))
                for place in range(first, last + 1):
                    assert manifest.fold(levels[0][place], manifest.path(place, leaves, derived)) == levels[-1][0]


def test_documents_with_clashing_columns(spark):
    docs = cases.documents(spark)
    assert manifest.proofs(manifest.leaves_of(docs), siblings=False).where("verified").count() == docs.count()
    assert manifest.proofs(manifest.leaves_of(cases.empty(spark))).collect() == []
