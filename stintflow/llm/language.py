"""Language identification by cross-parsing: a suffix automaton of labelled text per language reads every text in phrases, each the longest match that the
automaton has; the language that needs the fewest phrases, weighted by the bits that name a place in its text, wins.

Learning takes a bounded sample: ``SAMPLE_ROWS`` documents a language, one per hash bucket of the ids, and of each at most ``SAMPLE_ROW_CHARS`` characters from
a place drawn by its hash, so long documents teach as well. Each picked document gives an equal share of the language's ``LANGUAGE_CHARS`` characters (of
``TOTAL_CHARS`` over all languages; what short ones leave goes to the others). ``MAX_LANGUAGES`` bounds the languages learned: the most frequent ones. Every language has an
alphabet of its own, its ``ALPHABET`` most frequent letters. Whole texts are read, in segments of ``SEGMENT`` symbols that advance together; a phrase
ends with its segment, for all languages alike.

Defined results: NULL text or text without a letter is ``und`` with score 0, as is every text when there is nothing to learn from; ties go to
the language first in alphabetical order; a row without doc_id is no learning row and not held out; repeated rows are judged one by one.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import flat
from .ship import ship, unpack

SAMPLE_ROWS, SAMPLE_ROW_CHARS = 32, 20_000
LANGUAGE_CHARS, TOTAL_CHARS = 40_000, 400_000
ALPHABET, SEGMENT, MAX_LANGUAGES = 60, 512, 100
FOLDS = 5
OTHER, GAP = 0, 1  # symbols of letters beyond the alphabet, and of everything between letters


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def shares(sizes: list[int], total: int) -> list[int]:
    """Characters to take of each text: equal shares, the remainder of short texts dealt among the longer ones."""
    out = [0] * len(sizes)
    left = len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: sizes[k]):
        out[k] = min(sizes[k], total // left)
        total, left = total - out[k], left - 1
    return out


def sampled(docs: DataFrame) -> dict[str, str]:
    """Learning text of each language."""
    usable = docs.where(fold(F.col("doc_id")) != 0).where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    key = F.xxhash64(F.col("doc_id").cast("string"))
    begin = F.when(F.length("text") > SAMPLE_ROW_CHARS, F.pmod(F.xxhash64(key), F.length("text") - SAMPLE_ROW_CHARS + 1)).otherwise(0).cast("int")
    pieces = usable.select("lang", key.alias("h"), F.substring(F.col("text"), begin + 1, F.lit(SAMPLE_ROW_CHARS)).alias("piece"))
    frequent = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).select("lang")
    buckets = pieces.join(F.broadcast(frequent), "lang").groupBy("lang", F.pmod("h", F.lit(SAMPLE_ROWS)).alias("bucket")).agg(F.min("h").alias("h")).select("lang", "h")
    # One row for each language and bucket, whatever the ids and however often they occur.
    picks = pieces.join(F.broadcast(buckets), ["lang", "h"]).groupBy("lang", "h").agg(F.min("piece").alias("piece"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in picks.collect():  # MAX_LANGUAGES x SAMPLE_ROWS pieces
        texts.setdefault(row.lang, []).append((row.h, row.piece))
    size = min(LANGUAGE_CHARS, TOTAL_CHARS // max(1, len(texts)))
    out = {}
    for lang, rows in sorted(texts.items()):
        pieces_ = [t for _, t in sorted(rows)]
        out[lang] = "\n".join(t[:n] for t, n in zip(pieces_, shares([len(t) for t in pieces_], size)) if n)
    return out


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a string; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at >= 0:
            to = step[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                link[to] = link[new] = twin
                while at >= 0 and step[at].get(symbol) == to:
                    step[at][symbol] = twin
                    at = link[at]
        last = new
    return step


class Model:
    """``tables``: for each language a flat table of (state, symbol): the next state's place times 4, plus the phrases that end there. With
    ``TOTAL_CHARS`` symbols over all languages they take at most 2 x 400,000 states x 63 symbols x 4 bytes, some 200 MB; a few languages take a tenth of it."""

    def __init__(self, texts: dict[str, str]):
        self.languages = list(texts)
        letter = np.full(0x110000, GAP, np.uint8)
        letter[[c for c in range(0x110000) if chr(c).isalpha()]] = OTHER
        self.letter = letter
        self.known, self.codes = [], []  # the code points of each language's letters, in order, and their symbols
        self.tables, self.widths, self.bits = [], [], []
        for text in texts.values():
            common = Counter(c for c in text.lower() if c.isalpha())
            letters = np.sort(np.array([ord(c) for c, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]], np.uint32))
            self.known.append(letters)
            pad = len(letters) + 2
            width = pad + 1
            read = self.symbols(self.points(text), len(self.known) - 1)
            step = automaton(read.tolist())
            table = np.empty((len(step), width), np.int32)
            start = np.zeros(width, np.int32)
            for symbol, to in step[0].items():
                start[symbol] = to
            # Without a transition the phrase ends and the symbol begins the next; a symbol unknown even at the root is a phrase of its own.
            table[:] = start * (width * 4) + 1 + (start == 0)
            table[0] = start * (width * 4) + (start == 0)
            for state, moves in enumerate(step):
                for symbol, to in moves.items():
                    table[state, symbol] = to * (width * 4)
            table[:, OTHER] = 2  # a letter that the language does not use ends the phrase and is one of its own
            table[0, OTHER] = 1
            table[:, pad] = np.arange(len(step)) * (width * 4)
            self.tables.append(table.ravel())
            self.widths.append(width)
            self.bits.append(math.log2(len(read) + 2))

    def points(self, text: str) -> np.ndarray:
        """Code points of a text in lower case; a stretch without letters is one point without meaning (0)."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        if not len(codes):
            return codes
        codes = np.where(self.letter[codes] == GAP, 0, codes).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        return codes[keep]

    def symbols(self, points: np.ndarray, language: int) -> np.ndarray:
        letters = self.known[language]
        if not len(letters):
            return np.where(points == 0, GAP, OTHER).astype(np.uint8)
        at = np.minimum(np.searchsorted(letters, points), len(letters) - 1)
        return np.where(points == 0, GAP, np.where(letters[at] == points, at + 2, OTHER)).astype(np.uint8)

    def phrases(self, reads: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text (its points) in each language."""
        sizes = np.array([len(r) for r in reads], np.int64)
        segments = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(reads)), segments)
        begins = np.concatenate(([0], np.cumsum(segments)[:-1])) * SEGMENT
        flat_points = np.concatenate(reads) if reads else np.zeros(0, np.uint32)
        places = np.arange(len(flat_points)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        # The few different letters of the texts are looked up once a language.
        used, code = np.unique(flat_points, return_inverse=True)
        out = np.zeros((len(self.languages), len(reads)), np.int64)
        for k, (table, width) in enumerate(zip(self.tables, self.widths)):
            grid = np.full((len(owner), SEGMENT), width - 1, np.uint8)
            grid.reshape(-1)[places] = self.symbols(used, k)[code]
            columns = np.ascontiguousarray(grid.T).astype(np.int32)
            state = np.zeros(len(owner), np.int32)
            ended = np.zeros(len(owner), np.int32)
            for symbols in columns:
                found = table[state + symbols]
                ended += found & 3
                state = found >> 2
            out[k] = np.bincount(owner, weights=ended + (state > 0), minlength=len(reads))
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        reads = [self.points(t or "") for t in texts]
        lettered = np.array([bool((r != 0).any()) for r in reads], bool)
        cost = self.phrases(reads) * np.array(self.bits)[:, None] if self.languages else np.zeros((0, len(texts)))
        names, scores = [], []
        for k in range(len(texts)):
            if not lettered[k] or not self.languages:
                names.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmin(cost[:, k]))
            second = np.partition(cost[:, k], 1)[1] if len(self.languages) > 1 else math.inf
            names.append(self.languages[best])
            scores.append(float(1 - cost[best, k] / second))
        return names, scores


def learn(docs: DataFrame) -> Model:
    return Model(sampled(docs))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; only the text decides."""
    shipped = ship(docs.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack(shipped)
        for batch in batches:
            names, scores = [], []
            texts = batch.column("text")
            for a, b in flat.chunks(flat.utf8(texts)[1]):
                found = known.judge(texts.slice(a, b - a).to_pylist())
                names += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {key}, held_out boolean, lang_pred string, score double")
