import re
from collections import Counter

import pytest

from stintflow.llm import quality

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    marked = {}
    for n in quality.NGRAM_LIMITS:
        often = Counter(tuple(words[k:k + n]) for k in range(len(words) - n + 1))
        marked[n] = {j for k in range(len(words) - n + 1) if often[tuple(words[k:k + n])] > 1 for j in range(k, k + n)}
    chars, seen, again = sum(map(len, words)), set(), []
    for line in text.split("\n"):
        if WORD.search(line):
            again += [line] if line in seen else []
            seen.add(line)
    dup_line = sum(len(w) for line in again for w in WORD.findall(line))
    dup = {n: sum(len(words[k]) for k in marked[n]) for n in marked}
    failed = len(words) < 10 or 100 * len(marked[5]) > 20 * len(words)
    over = dup_line > quality.LINE_LIMIT * chars or any(dup[n] > limit * chars for n, limit in quality.NGRAM_LIMITS.items())
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(again), len(marked[5]), dup_line, *dup.values(), failed, not failed and not over)


@pytest.mark.parametrize("name", ["given", "cases", "awkward", "empty"])
def test_against_brute_force(spark, name):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet") if name == "given" else {"cases": cases.documents, "awkward": cases.awkward, "empty": cases.empty}[name](spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in quality.repetition(docs).collect()), key=repr)
    assert got == sorted(((key, *brute(text)) for key, text in rows), key=repr)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(g[-1] for g in got)


def test_texts_that_only_the_method_rejects(spark):
    fresh = lambda n, start=0: [f"w{k:04}" for k in range(start, start + n)]
    phrases = [w for k in range(0, 25, 5) for w in fresh(5, k) + fresh(8, 100 + 10 * k) + fresh(5, k) + fresh(8, 1000 + 10 * k)]
    rows = [(1, fresh(17) + fresh(150, 100) + fresh(17)), (2, fresh(12) + fresh(180, 100) + fresh(12)), (3, phrases + fresh(150, 3000)), (4, phrases + fresh(290, 3000))]
    got = {r.doc_id: r for r in quality.repetition(cases.documents(spark, [(key, " ".join(words)) for key, words in rows])).collect()}
    assert not any(r.base_failed for r in got.values())
    # Two copies of 17 words, two copies of 12 (only the limit of 10 words is passed), many phrases of five words, and fewer of them.
    assert {key: r.kept for key, r in got.items()} == {1: False, 2: False, 3: False, 4: True}
    assert got[2].dup_5gram_chars < 0.13 * got[2].word_chars and got[3].dup_7gram_chars == 0


def thue_morse(size):
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_and_lines_that_collide_modulo_a_power_of_two():
    import numpy as np
    from stintflow.llm import flat, minmax
    one = thue_morse(2048)
    two = one.translate(str.maketrans("ab", "ba"))
    assert one != two
    lines = f"{one}\n{two}\n"
    words = " ".join([one, "w", "x", "y", "z", two, "w", "x", "y", "z"])
    for text in (lines, words):
        data = np.frombuffer(text.encode(), np.uint8)
        found = quality.measure(data, np.array([0, len(data)]))
        assert found["n_dup_lines"].tolist() == [0] and found["n_repeat_words"].tolist() == [0]
    data = np.frombuffer(f"{one} a b c{two} a b c{one} a b c".encode(), np.uint8)
    size = len(data) // 3
    keys, owners, _ = minmax.shingle_sets(data, np.array([0, size, 2 * size, 3 * size]), 4)
    assert keys[owners == 0].tolist() != keys[owners == 1].tolist() and keys[owners == 0].tolist() == keys[owners == 2].tolist()
    assert flat.LONG < 1024


def test_a_task_gives_its_memory_back(monkeypatch):
    from stintflow.llm import flat
    calls = []
    monkeypatch.setattr(flat, "give_back", lambda: calls.append(1))
    task = flat.released(lambda batches: (2 * batch for batch in batches))(iter([1, 2]))
    assert next(task) == 2 and not calls
    assert list(task) == [4] and calls == [1]
