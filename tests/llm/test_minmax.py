import re
from collections import Counter, defaultdict

import pytest

from stintflow.llm import minmax
from stintflow.llm.components import components

from . import cases

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = WORD.findall(cases.low(text))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(rows, n, percent=80):
    sets, holders = [(key, shingles(text, n)) for key, text in rows if key is not None], defaultdict(list)
    root = {key: key for key, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for place, (key, own) in enumerate(sets):
        shared = Counter(p for s in own for p in holders[s])
        for s in own:
            holders[s].append(place)
        for p, k in shared.items():
            if 100 * k >= percent * (len(own) + len(sets[p][1]) - k):
                a, b = sorted((top(key), top(sets[p][0])))
                root[b] = a
    return sorted(((key, len(shingles(text, n)), None if key is None else top(key), key is None or top(key) == key) for key, text in rows), key=repr)


@pytest.mark.parametrize("name,n", [("given", 4), ("cases", 4), ("cases", 5), ("awkward", 3)])
def test_against_brute_force(spark, name, n):
    docs = {"given": lambda s: s.read.parquet(f"{cases.SMALL}/documents.parquet"), "cases": cases.documents, "awkward": cases.awkward}[name](spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in minmax.near_duplicates(docs, n).collect()), key=repr) == brute(rows, n)


def test_many_edits_of_one_text(spark):
    """Members that are apart from the smallest one, but linked with each other."""
    words = [f"w{k}" for k in range(100)]

    def edited(places):
        return " ".join(f"z{k}" if k in places else w for k, w in enumerate(words))
    rows = [(n, edited(range(0, 100, 9))) for n in (1,)] + [(10 + n, edited({n})) for n in range(60)] + [(100 + n, edited(range(n, 100, 10))) for n in range(10)] + [(200, edited(range(0, 100, 9)) + " tail")]
    got = sorted((tuple(r) for r in minmax.near_duplicates(cases.documents(spark, rows), 4).collect()), key=repr)
    assert got == brute(rows, 4)


def test_keep_one_and_empty(spark):
    docs = cases.documents(spark)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 5)
    kept = minmax.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expected if e[-1])
    assert minmax.near_duplicates(cases.empty(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (500, 400), (400, 500)]
    found = {r.node: r.least for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}, 500: 400}


def test_one_of_repeated_rows_stays(spark):
    text = "one two three four five six seven"
    rows = [(1, text)] * 3 + [(None, text)] * 4 + [(None, "other words that nobody else has said so far")] * 2 + [(5, text), (None, None), (None, None), (7, ""), (7, "")]
    kept = minmax.keep_one(cases.documents(spark, rows).repartition(3))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("1", text), ("None", "other words that nobody else has said so far"), ("None", "None"), ("None", "None"), ("7", ""), ("7", "")])
