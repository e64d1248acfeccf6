"""Personal data: regular expressions propose spans, checksums confirm them, context words before and after adjust their score.

Built-in functions only. A pattern's matches come from ``regexp_extract_all`` and the text between them from ``split``, so the places
of all matches are running sums of lengths. The patterns are possessive and start only where a match can start, sums and lists are scanned in blocks of
``BLOCK`` matches, and pieces of the text are cut from its UTF-32 form, where a place is an offset: all of it is linear in the text and its matches.

An account number of a registered country has that country's length, written in one piece or in groups of four, so what follows it is not taken
for a part of it; other country codes take the longest form. Context is the 40 characters of the whole text before and after a span, other spans
included, and holds for a whole list: spans of a kind with nothing but separators between them share it.

Defined results: a NULL text is empty; repeated rows are searched one by one; all other columns are ignored (``find``) or kept (``masked``).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

CONTEXT_CHARS, CONTEXT_GAIN, ACCEPTED = 40, 0.4, 0.5
BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """``hint``: a cheap sign that a text may hold a match. ``base``: a confirmed match counts whatever its score."""
    name: str
    pattern: str
    hint: str
    score: float
    context: str
    base: bool = True


# Lengths of account numbers by country (ISO 13616).
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
                23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
                28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    def form(length: int, countries: str) -> str:
        groups, rest = divmod(length - 4, 4)
        spaced = f"(?: [A-Z0-9]{{4}}){{{groups}}}" + (f" [A-Z0-9]{{{rest}}}" if rest else "")
        return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{length - 4}}}|{spaced})(?![A-Za-z0-9])"
    registered = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = rf"[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}+|(?: (?!(?:{registered})[0-9]{{2}})[A-Z0-9]{{4}}){{2,7}}+(?: [A-Z0-9]{{1,3}})?+)(?![A-Za-z0-9])"
    return "(?<![A-Za-z0-9])(?:" + "|".join(form(n, c) for n, c in IBAN_LENGTHS.items()) + f"|{other})"


# What may stand between the spans of a list.
LISTED = r"^[\s,;/|&]*(?:(?:and|or|und|oder|et|ou|y|o)\b[\s,;/|&]*)?$"

KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write to"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", 0.6, "ip|address|host|server"),
    Kind("card", r"[0-9](?:[ -]?+[0-9]){13,}+", r"[0-9](?:[ -]?+[0-9]){13}", 0.8, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, "phone|tel|call|mobile|fax"),
    Kind("iban", _iban_pattern(), r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{11}", 0.6, "iban|account|bank|transfer|konto", False),
    Kind("routing", r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-]|\.[0-9])", r"[0-9]{9}", 0.2, "routing|aba|rtn", False),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, "ssn|social security|tax id", False),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Remainder of an account number whose first four characters go to the end and whose letters count from 10."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest, sign):
        code = F.ascii(sign)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)
    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), step)


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        # Leading zeros do not change a part; more than three further digits are over 255 in any case.
        return F.forall(F.split(match, r"\."), lambda part: F.ltrim(part, F.lit("0")).rlike("^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return _mod97(match) == 1
    if kind == "routing":
        weighed = sum(F.substring(match, k + 1, 1).cast("int") * w for k, w in enumerate((3, 7, 1) * 3))
        return (match != "000000000") & (weighed % 10 == 0)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and deep in other lambdas the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, begin: Column, step, out: str) -> Column:
    """Array of what ``step(state, item)`` gives for each item in turn, with ``begin`` as the first state.

    Arrays only grow inside a block and by one entry a block, so the cost is near the number of items and not its square.
    """
    none, nothing = F.array().cast(f"array<{out}>"), F.array().cast(f"array<array<{out}>>")

    def grown(state, item):
        return _let(step(state["state"], item), lambda now: F.struct(now["state"].alias("state"), F.concat(state["out"], F.array(now["out"])).alias("out")))

    def block(done, own):
        return F.aggregate(own, F.struct(done["state"].alias("state"), none.alias("out")), grown,
                           lambda last: F.struct(last["state"].alias("state"), F.concat(done["out"], F.array(last["out"])).alias("out")))

    def whole(own):
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(own) / BLOCK).cast("int") - 1), lambda b: F.slice(own, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(own) > 0, F.flatten(F.aggregate(blocks, F.struct(begin.alias("state"), nothing.alias("out")), block, lambda done: done["out"]))).otherwise(none)
    return _let(items, whole)


def _step(state: Column, out: Column) -> Column:
    return F.struct(state.alias("state"), out.alias("out"))


def _starts(matches: Column, gaps: Column) -> Column:
    sizes = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("match")))
    return _scan(sizes, F.lit(0), lambda at, size: _step(at + size["gap"] + size["match"], at + size["gap"]), "int")


def _cut(text: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text in UTF-32."""
    return F.decode(F.substring(text, start * 4 + 1, (end - start) * 4), "UTF-32")


def _spans(kind: Kind, order: int) -> Column:
    """Confirmed spans from the columns ``_m`` (matches), ``_g`` (gaps) and ``_s`` (starts) of a kind, and ``_u``, the text in UTF-32."""
    matches, gaps, starts = (F.col(c) for c in (f"_m{order}", f"_g{order}", f"_s{order}"))
    word = rf"\b(?:{kind.context})"

    def around(one, gap, given):
        before = _cut(given["text"], F.greatest(one["start"] - CONTEXT_CHARS, F.lit(0)), one["start"])
        behind = _cut(given["text"], one["end"], F.least(one["end"] + CONTEXT_CHARS, given["size"]))
        return F.struct(F.lower(before).rlike(word).alias("before"), F.lower(behind).rlike(word).alias("behind"),
                        ((F.length(gap) <= CONTEXT_CHARS) & gap.rlike(LISTED)).alias("listed"))

    def said(near):
        # A word before the first span of a list holds for those that follow, a word behind the last for those before it.
        nexts = F.zip_with(near, F.slice(near, F.lit(2), F.size(near)), lambda n, after: F.struct(n["behind"].alias("word"), F.coalesce(after["listed"], F.lit(False)).alias("listed")))
        firsts = F.transform(near, lambda n: F.struct(n["before"].alias("word"), n["listed"].alias("listed")))
        def carried(items):
            return _scan(items, F.lit(False), lambda state, n: _step(n["word"] | (n["listed"] & state), n["word"] | (n["listed"] & state)), "boolean")
        return F.zip_with(carried(firsts), F.reverse(carried(F.reverse(nexts))), lambda a, b: a | b)

    def span(one, named):
        score = F.least(F.lit(kind.score) + F.when(named, CONTEXT_GAIN).otherwise(0.0), F.lit(1.0))
        good = _valid(kind.name, one["match"])
        return F.struct(one["start"].alias("start"), F.lit(order).alias("ord"), one["end"].alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"),
                        (good if kind.base else good & (score >= ACCEPTED)).alias("good"))

    def found(given):
        near = F.zip_with(given["placed"], F.slice(given["gaps"], F.lit(1), F.size(given["placed"])), lambda one, gap: around(one, gap, given))
        kept = F.filter(F.zip_with(given["placed"], _let(near, said), span), lambda s: s["good"])
        return F.transform(kept, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "ord", "end", "kind", "score")]))
    placed = F.zip_with(matches, starts, lambda m, at: F.struct(m.alias("match"), at.alias("start"), (at + F.length(m)).alias("end")))
    return _let(F.struct(F.col("_u").alias("text"), F.col("_size").alias("size"), gaps.alias("gaps"), placed.alias("placed")), found)


def _with_spans(rows: DataFrame) -> DataFrame:
    """``rows`` (a column ``_text`` without NULL, and ``_row``) with ``_spans``: accepted spans by start and kind."""
    found = rows
    for k, kind in enumerate(KINDS):
        text = F.col("_text")
        likely = F.contains(text, F.lit(kind.hint)) if len(kind.hint) == 1 else text.rlike(kind.hint)
        found = found.withColumn(f"_g{k}", F.when(likely, F.split(text, kind.pattern, -1)))
        found = found.withColumn(f"_m{k}", F.when(F.size(f"_g{k}") > 1, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))))
    any_match = F.lit(False)
    for k, _ in enumerate(KINDS):
        any_match = any_match | F.coalesce(F.size(f"_m{k}") > 0, F.lit(False))
    found = found.withColumn("_u", F.when(any_match, F.encode("_text", "UTF-32")))
    found = found.withColumns({"_size": (F.octet_length("_u") / 4).cast("int"), **{f"_s{k}": F.when(F.size(f"_m{k}") > 0, _starts(F.col(f"_m{k}"), F.col(f"_g{k}"))) for k, _ in enumerate(KINDS)}})
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,score:double>>")
    every = [F.when(F.size(f"_m{k}") > 0, _spans(kind, k)).otherwise(none) for k, kind in enumerate(KINDS)]
    return found.select("_row", "_text", "_u", "_size", F.array_sort(F.concat(*every)).alias("_spans"))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` with each accepted span's start, end (code points, end exclusive), kind and score."""
    rows = docs.select(F.struct("doc_id").alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    return _with_spans(rows).select("_row.doc_id", F.col("_text").alias("text"), F.col("_spans").alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans, and the score of each."""
    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    counts = [count(kind.name) for kind in KINDS if kind.base]
    base = F.filter("spans", lambda s: s["kind"].isin(*[kind.name for kind in KINDS if kind.base]))
    return find(docs).select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"),
                             F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


def masked(docs: DataFrame) -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets; overlapping spans become one."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))

    def replaced(given):
        text, spans = given["text"], given["spans"]
        ends = _scan(spans, F.lit(0), lambda at, span: _step(F.greatest(at, span["end"]), at), "int")  # the end of all spans before each
        said = F.zip_with(spans, ends, lambda span, at: F.when(span["start"] >= at, F.concat(_cut(text, at, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(""))
        return F.concat(F.array_join(said, ""), _cut(text, F.array_max(F.transform(spans, lambda span: span["end"])), given["size"]))
    whole = _let(F.struct(F.col("_u").alias("text"), F.col("_size").alias("size"), F.col("_spans").alias("spans")), replaced)
    return _with_spans(rows).select(*[F.when(F.size("_spans") > 0, whole).otherwise(F.col("_row.text")).alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c)
                                      for c in docs.columns])
