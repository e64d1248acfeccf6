import hashlib
import re

from stintflow.llm import leaks

from . import cases

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    known = {}
    for item, text in items:
        words = WORD.findall(cases.low(text))
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            known.setdefault(tuple(words[k:k + size]), set()).add(str(item))
    out = []
    for key, text in rows:
        words, hit, found = WORD.findall(cases.low(text)), set(), set()
        for size in {len(k) for k in known}:
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in known:
                    hit |= set(range(k, k + size))
                    found |= known[tuple(words[k:k + size])]
        out.append((key, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def search(docs, bench):
    return sorted(tuple(r) for r in leaks.contamination(docs, bench).collect())


def test_given_tables(spark):
    docs, bench = (spark.read.parquet(f"{cases.SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    assert search(docs, bench) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]))


def items(texts):
    return [(n, t) for n, t in enumerate([texts[20], texts[20], " ".join((texts[40] or "").split()[:4]), texts[60], "X", None, "...", texts[-1]])]


def test_small_cases_and_several_passes(spark, monkeypatch):
    texts = cases.texts()
    rows = list(enumerate(texts))
    bench = spark.createDataFrame(items(texts), "item_id long, text string")
    expected = brute(rows, [i for i in items(texts) if i[1] is not None])
    assert search(cases.documents(spark, rows), bench) == expected
    monkeypatch.setattr(leaks, "PASS_BYTES", 600)
    assert search(cases.documents(spark, rows), bench) == expected
    kept = leaks.keep_clean(cases.documents(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [e[0] for e in expected if not e[-1]]
    assert kept.columns == cases.documents(spark).columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in leaks.contamination(cases.documents(spark), none).collect()} == {False}
    assert leaks.keep_clean(cases.documents(spark), none).count() == cases.documents(spark).count()
    assert leaks.contamination(cases.empty(spark), none).collect() == []
    assert leaks.contamination(cases.awkward(spark), none).count() == 7
