"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing further columns."""
import random
import re

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def low(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())


def texts(seed=7, count=120):
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdeé") for _ in range(pick.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(pick.choice(words) for _ in range(n))
    base, passage = [say(60) for _ in range(5)], say(30)
    out = [None, "", " \n\t", "Von.", "x", "a" * 50_000, "ab " * 20_000, "Ä ö ü z", "\x00\x01 b"]
    for _ in range(count):
        kind = pick.random()
        if kind < 0.25:
            out.append(pick.choice(base))
        elif kind < 0.6:
            changed = pick.choice(base).split(" ")
            for _ in range(pick.randint(1, 8)):
                changed[pick.randrange(len(changed))] = pick.choice(words)
            out.append(" ".join(changed))
        elif kind < 0.8:
            out.append(f"{say(pick.randint(0, 20))}\n{passage}\n{say(pick.randint(0, 20))}")
        else:
            out.append(say(pick.randint(1, 90)))
    return out


def documents(spark, rows=None):
    """``documents`` with columns that clash with those the operators make."""
    rows = rows if rows is not None else list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("clash") for c in ("key", "band", "bands", "a", "b", "part", "node", "least", "rep", "size", "spans", "kept", "anchor", "piece", "length", "start", "rank",
                                         "block", "place", "leak_items", "held_out", "digest", "row", "_row", "_text", "_spans", "n_words", "component_id")}
    return df.withColumns(clash)


def awkward(spark):
    """Null ids, repeated ids with equal and with other texts."""
    return documents(spark, [(None, None), (None, "one two three four five six"), (1, "one two three four five six"), (1, "one two three four five six"), (1, "seven eight nine"), (2, None), (2, None)])


def empty(spark):
    return documents(spark, [])
