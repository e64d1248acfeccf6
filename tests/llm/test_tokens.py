import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from stintflow.llm import balanced, lengths, packing
from stintflow.llm.tokens import Encoder, vocabulary_path

from . import cases


@pytest.fixture(scope="module")
def reference():
    known = Tokenizer.from_file(vocabulary_path())
    return lambda text: known.encode(text or "", add_special_tokens=False).ids


SPECIAL = [(1, "end <|endoftext|> begin"), (2, "<|endoftext|>" * 1500), (3, "<|endoftext"), (4, None)]


def given(spark, name):
    return {"given": lambda s: s.read.parquet(f"{cases.SMALL}/documents.parquet"), "cases": cases.documents, "awkward": cases.awkward, "empty": cases.empty,
            "special": lambda s: cases.documents(s, SPECIAL)}[name](spark)


def test_same_ids_as_the_tokenizers_library(spark, reference):
    encoder = Encoder(vocabulary_path())
    texts = [r.text for r in given(spark, "given").collect()] + cases.texts() + ["<|endoftext|> it's\r\n\t x", "end <|endoftext|> begin", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", " " * 300, "١٢٣ ½ 漢字 🙂"]
    for text in texts:
        assert encoder.ids(text or "").tolist() == reference(text)


@pytest.mark.parametrize("name", ["given", "cases", "awkward", "empty", "special"])
def test_packing_round_trip(spark, reference, name):
    docs = given(spark, name)
    rows = packing.packed(docs).collect()
    want = Counter()
    for doc in docs.collect():
        ids = np.array([*reference(doc.text), 2], "<u4")
        for k, (a, b) in enumerate(packing.cut(len(ids), 1024)):
            want[doc.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_plan_places_every_piece_as_best_fit_does():
    pick = random.Random(1)
    for _ in range(40):
        capacity = pick.choice([10, 64, 200])
        counts = {n: pick.randint(1, 60) for n in range(1, capacity + 1) if pick.random() < 0.6}
        slots, opened = packing.plan(counts, capacity)
        ranks, used = Counter(), {}
        for length, rank, first, offset, number in slots.tolist():
            assert rank == ranks[length]
            ranks[length] += number
            for k in range(number):
                used.setdefault(first + k, []).append((offset, length))
        assert dict(ranks) == counts and len(used) == opened
        for own in used.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity
        free = []  # best-fit decreasing, piece by piece
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fit = min((f for f in free if f >= length), default=None)
                if fit is None:
                    free.append(capacity - length)
                else:
                    free[free.index(fit)] = fit - length
        assert opened == len(free)


def test_histogram(spark, reference):
    docs = cases.documents(spark, list(enumerate(cases.texts())) + [(1000 + i, t) for i, t in SPECIAL])
    sizes = [len(reference(r.text)) for r in docs.collect()]
    sums = lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(docs)))
    for r in sums.collect():
        n = r.length
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n))
        assert (r.truncated_tokens, r.docs_below, r.all_docs, r.all_tokens) == (sum(min(s, n) for s in sizes), sum(s < n for s in sizes), len(sizes), sum(sizes))
    for limit in (0, 17, 128, 10**6):
        assert tuple(lengths.truncated_total(sums, limit).first()) == (sum(min(s, limit) for s in sizes), sum(s > limit for s in sizes))
    assert lengths.quantile(sums, 0.5).first().length == sorted(sizes)[-(-len(sizes) // 2) - 1]
    assert lengths.suffix_sums(lengths.histogram(lengths.encoded_lengths(cases.empty(spark)))).collect() == []
    assert lengths.encoded_lengths(cases.awkward(spark)).count() == 7


@pytest.mark.parametrize("name", ["given", "cases", "awkward", "empty", "special"])
def test_balanced_windows(spark, reference, name, monkeypatch):
    monkeypatch.setattr(balanced, "WINDOWS", 16)
    docs = given(spark, name)
    rows = balanced.packed(docs).collect()
    ids = {}
    for doc in docs.collect():
        ids.setdefault(doc.doc_id, []).append(np.array([*reference(doc.text), 1], "<u4"))
    left = Counter((key, len(i), zlib.crc32(i[a:b].tobytes()), a, b - a) for key, docs in ids.items() for i in docs for a, b in balanced.cut(i))
    assert Counter((r.doc_id, r.doc_tokens, r.ids_crc32, r.start, r.length) for r in rows) == left
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_pieces_tile_every_document():
    for size in (*range(1, 60), 2047, 2048, 2049, 5000):
        ids = np.arange(size, dtype="<u4")
        edges = balanced.cut(ids)
        assert edges[0][0] == 0 and edges[-1][1] == size
        assert all(a < b <= a + 2048 for a, b in edges) and all(x[1] == y[0] for x, y in zip(edges, edges[1:]))


def test_differencing_balances():
    pick = random.Random(2)
    for _ in range(30):
        sizes = [pick.randint(1, 60) for _ in range(pick.randint(1, 80))]
        windows = pick.randint(1, 20)
        found, sums = balanced.difference(sizes, windows)
        assert np.bincount(found, weights=sizes, minlength=windows).tolist() == sums.tolist()
        # by the definition: whole lists of windows, sorted anew at each step
        parts = [(sorted([s, *[0] * (windows - 1)], reverse=True), k) for k, s in enumerate(sizes)]
        number = len(sizes)
        while len(parts) > 1:
            parts.sort(key=lambda p: (-(p[0][0] - p[0][-1]) if windows > 1 else -p[0][0], p[1]))
            one, two = parts.pop(0)[0], parts.pop(0)[0]
            parts.append((sorted((a + b for a, b in zip(one, reversed(two))), reverse=True), number))
            number += 1
        assert max(parts[0][0]) - min(parts[0][0]) == sums.max() - sums.min()


def test_windows_are_nearly_full():
    pick = np.random.default_rng(4)
    sizes = np.concatenate([np.minimum(pick.lognormal(6.3, 0.6, 1200).astype(np.int64), 2047), pick.integers(8, 128, 1200), np.ones(5000, np.int64)])
    window = balanced.windows_of(sizes)
    used = np.bincount(window, weights=sizes)
    assert used.max() <= 2048 and used.min() > 0
    assert 1 - sizes.sum() / (2048 * len(used)) < 0.01
    assert balanced.windows_of(np.full(100_000, 1)).max() + 1 <= 50
