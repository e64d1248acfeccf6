import hashlib
import random

import pytest

from stintflow.llm import repeats

from . import cases


def brute(rows):
    seen, out = set(), []
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(raw[k:k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out.append((key, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows_with_repeats():
    pick = random.Random(5)
    say = lambda n, letters="abcdef ": "".join(pick.choice(letters) for _ in range(n))
    base, line, passage = [say(400) for _ in range(6)], say(60), say(130)
    out = []
    for i in range(200):
        kind = pick.random()
        if kind < 0.2:
            text = pick.choice(base)
        elif kind < 0.5:
            text = list(pick.choice(base))
            for _ in range(pick.randint(1, 4)):
                text[pick.randrange(len(text))] = "é"
            text = "".join(text)
        elif kind < 0.7:
            text = say(pick.randint(0, 300)) + line + say(pick.randint(0, 200))
        elif kind < 0.9:
            text = say(pick.randint(0, 100)) + passage + say(pick.randint(0, 100)) + passage[:pick.randint(90, 130)]
        else:
            text = pick.choice(["", None, "a" * 500, "ab" * 300, "x" * 99, "x" * 100, "x" * 101, say(100, "é")])
        out.append((i * 3, text))
    return out


@pytest.mark.parametrize("rows", [rows_with_repeats(), list(enumerate(cases.texts()))], ids=["repeats", "cases"])
def test_against_brute_force(spark, rows):
    got = sorted(tuple(r) for r in repeats.report(cases.documents(spark, rows).repartition(7)).collect())
    assert got == brute(rows)


def test_crowded_anchors_are_dealt_by_strings(spark):
    rows = rows_with_repeats()
    got = repeats.removed_spans(cases.documents(spark, rows).repartition(5), group_snippets=3).collect()
    assert sorted((r.doc_id, sum(s.high - s.low for s in r.spans), len(r.spans)) for r in got) == [(k, n, s) for k, _, n, s, _ in brute(rows)]


def test_given_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{cases.SMALL}/documents.parquet").collect())
    assert sorted(tuple(r) for r in repeats.report(spark.read.parquet(f"{cases.SMALL}/documents.parquet")).collect()) == brute(rows)


def test_awkward_ids_are_ordered_by_id_and_text(spark):
    pick = random.Random(1)
    text = "".join(pick.choice("abcdefgh ") for _ in range(300))
    rows = [(2, text), (1, text), (1, text), (None, text), (None, None)]
    got = repeats.report(cases.documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == [(0, 0, 0), (0, 300, 0), (1, 300, 300), (1, 300, 300), (2, 300, 300)]


def test_empty(spark):
    assert repeats.report(cases.empty(spark)).collect() == []
