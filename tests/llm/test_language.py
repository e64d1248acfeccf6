import zlib

import numpy as np

from stintflow.llm import language

from . import cases


def brute(text: bytes, learned: bytes) -> int:
    """Phrases of a greedy cross-parse, segment by segment."""
    count = 0
    for begin in range(0, len(text), language.SEGMENT):
        part, k = text[begin:begin + language.SEGMENT], 0
        while k < len(part):
            n = 0
            while k + n < len(part) and part[k:k + n + 1] in learned:
                n += 1
            count += 1
            k += max(n, 1)
    return count


def test_phrases_against_brute_force():
    texts = {"a": "the cat sat on the mat and the dog sat too", "b": "der hund und die katze sind in der küche"}
    model = language.Model(texts)
    for text in ["the catze sat", "der dog!!  xx", "on the der mat und", "küche the " * 120, "a", "zzz", "привет the мир"]:
        points = model.points(text)
        for k, learned in enumerate(texts.values()):
            own = bytes(model.symbols(model.points(learned), k))
            # A letter beyond the alphabet matches nothing that was learned.
            assert language.OTHER not in own
            assert model.phrases([points, model.points("the")])[k, 0] == brute(bytes(model.symbols(points, k)), own)


def test_letters_of_every_language_count():
    alphabets = {"latin": "abcdefghij", "greek": "αβγδεζηθικ", "cyrillic": "абвгдежзик", "georgian": "აბგდევზთიკ", "hebrew": "אבגדהוזחטי", "armenian": "աբգդեզէըթժ", "hangul": "가나다라마바사아자차"}
    import random
    pick = random.Random(1)
    say = lambda letters: " ".join("".join(pick.choice(letters) for _ in range(4)) for _ in range(40))
    model = language.Model({name: say(letters) for name, letters in sorted(alphabets.items())})
    for name, letters in alphabets.items():
        assert model.judge([say(letters)])[0] == [name]


def test_the_sample_is_bounded_and_fair(spark):
    rows = [(1, "same id " * 3, "en")] * 800 + [(k, "long text " * 9_000, "long") for k in range(2, 60)] + [(k, f"short {k}", "short") for k in range(60, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.sampled(docs)
    assert learned["en"] == "same id " * 3
    assert abs(len(learned["long"]) - language.LANGUAGE_CHARS) < 40 and learned["long"].count("\n") > 15
    assert learned["short"].count("\n") == language.SAMPLE_ROWS - 1
    assert language.shares([10, 1, 100, 100], 60) == [10, 1, 24, 25] and sum(language.shares([5, 5], 60)) == 10


def test_accuracy_on_documents_held_out(spark):
    docs = spark.read.parquet(f"{cases.SMALL.replace('0.001', '0.01')}/documents.parquet")
    model = language.learn(docs)
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in held) and sum(g.held_out for g in got.values()) == len(held)
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= g.score <= 1 for g in got.values())


def test_defined_results(spark):
    docs = cases.documents(spark)
    got = {r.doc_id: r for r in language.identify(docs, language.learn(docs)).collect()}
    assert all(got[r.doc_id].lang_pred == ("en" if any(c.isalpha() for c in r.text or "") else "und") for r in docs.collect())
    unlabelled = docs.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in language.identify(docs, language.learn(unlabelled)).collect()} == {("und", 0.0)}
    assert language.identify(cases.awkward(spark), language.learn(cases.awkward(spark))).count() == 7
    assert language.identify(cases.empty(spark), language.learn(cases.empty(spark))).collect() == []
