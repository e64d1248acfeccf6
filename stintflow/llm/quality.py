"""Repetition coverage: rolling hashes of several n-gram lengths, and the characters inside repeated n-grams and lines.

Defined results: a NULL or empty text has no words and fails the base rule; repeated rows are judged one by one; an empty
table gives an empty result; columns of the input other than the text are carried along only by ``keep_good``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import flat

# Largest share of word characters inside n-grams that occur twice or more in the text, and inside lines seen before. All lie below the base
# rule's share of words, or they would add nothing to it, and they fall with the length: five words recur as idioms and names, ten hardly ever
# unless a passage is copied. These are the values usual for web text (15 % at 5 words, one less for each word more).
NGRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
LINE_LIMIT = 0.30
MIN_WORDS, REPEAT_PERCENT = 10, 20
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, "
            + ", ".join(f"dup_{n}gram_chars long" for n in NGRAM_LIMITS) + ", base_failed boolean, kept boolean")
_NAMES = [part.split()[0] for part in MEASURES.split(", ")]

_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def measure(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every text of one chunk."""
    count = len(bounds) - 1
    inside = flat.NOT_SPACE[data]
    starts, ends = flat.spans(inside, bounds)
    owner = flat.text_of(starts, bounds)
    sums = flat.byte_prefix(data)
    words = flat.strings(data, sums, starts, ends)
    points = np.concatenate(([0], np.cumsum(((data & 0xC0) != 0x80) & inside)))
    chars = points[ends] - points[starts]
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    out = {"n_words": flat.per_text(np.ones(len(owner)), owner, count), "word_chars": flat.per_text(chars, owner, count),
           "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]]}

    line_starts, line_ends = flat.spans(data != 10, bounds)
    worded = points[line_ends] > points[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_owner = flat.text_of(line_starts, bounds)
    line_chars = points[line_ends] - points[line_starts]
    joint = flat.mixed(flat.strings(data, sums, line_starts, line_ends) + line_owner.astype(np.uint64) * np.uint64(flat.WORD_BASE))
    again = np.ones(len(joint), bool)
    again[np.unique(joint, return_index=True)[1]] = False
    out["n_dup_lines"] = flat.per_text(again, line_owner, count)
    out["dup_line_chars"] = flat.per_text(line_chars * again, line_owner, count)

    for n in NGRAM_LIMITS:
        first, keys = flat.windows(words, owner, n)
        marked = flat.covered(first[flat.repeated(keys, owner[first])], n, len(words))
        if n == 5:
            out["n_repeat_words"] = flat.per_text(marked, owner, count)
        out[f"dup_{n}gram_chars"] = flat.per_text(marked * chars, owner, count)
    return out


def judge(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    m["base_failed"] = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    over = m["dup_line_chars"] > LINE_LIMIT * m["word_chars"]
    for n, limit in NGRAM_LIMITS.items():
        over |= m[f"dup_{n}gram_chars"] > limit * m["word_chars"]
    m["kept"] = ~m["base_failed"] & ~over
    return m


def _measured(column: pa.Array) -> dict[str, np.ndarray]:
    data, bounds = flat.utf8(column)
    parts = [judge(measure(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])) for a, b in flat.chunks(bounds)]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, np.int64) for name in _NAMES}


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = _measured(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[n]) for n in _NAMES)], ["doc_id", *_NAMES])


def repetition(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every text: ``doc_id`` and the columns of ``MEASURES``."""
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(flat.released(_batches), f"doc_id {key}, {MEASURES}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_measured(batch.column("text"))["kept"]))
    return docs.mapInArrow(flat.released(passing), docs.schema)


def statement(limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> str:
    """The same in SQL, on the table ``documents``."""
    grams = ",\n".join(f"""again{n} AS (SELECT r, i FROM (SELECT r, i, array_to_string(w[i:i + {n - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {n - 2})) AS i FROM docs))
  QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
inside{n} AS (SELECT r, count(*) AS n_inside, sum(length(x)) AS chars FROM words JOIN (SELECT DISTINCT r, unnest(range(i, i + {n})) AS i FROM again{n}) USING (r, i) GROUP BY r)""" for n in limits)
    dup = ", ".join(f"CAST(coalesce(inside{n}.chars, 0) AS BIGINT) AS dup_{n}gram_chars" for n in limits)
    over = " OR ".join([f"dup_line_chars > {line_limit} * word_chars", *(f"dup_{n}gram_chars > {limit} * word_chars" for n, limit in limits.items())])
    joins = " ".join(f"LEFT JOIN inside{n} USING (r)" for n in limits)
    return rf'''WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM docs),
lines AS (SELECT r, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs) GROUP BY r, line),
dup AS (SELECT r, sum(n - 1) AS n_dup, sum((n - 1) * chars) AS chars FROM lines WHERE chars > 0 GROUP BY r),
{grams},
counted AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, coalesce(inside5.n_inside, 0) AS n_repeat_words, CAST(coalesce(dup.chars, 0) AS BIGINT) AS dup_line_chars, {dup}
  FROM docs LEFT JOIN dup USING (r) {joins})
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR {over}) AS kept FROM counted'''
