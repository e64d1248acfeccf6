"""Main text of web pages by nearest-URL differencing.

Pages are ordered by path within their host; pages with equal lines are copies and form one class. A page is compared with pages of other
classes only, the nearest before and behind it, by longest common subsequence of their text lines:

* A page that marks no article is compared with the one whose path shares the longer beginning. Lines that both share, blocks of links among
  them, are taken for the site's template and deleted.
* Where a page marks its article (or main element), only lines inside are text. Articles of one site may well share sentences, so such a line is
  deleted only if all of the ``WITNESSES`` nearest pages share it, versions of the same article not counted.

Markup says what needs no comparison: menus, page headers, footers, asides, forms, scripts, styles and reader comments never count. A class name, id or role
only raises a doubt: the element goes unless it holds an article or most of the page's text (see ``_Reader``).

Pages are parsed once, into written lines. Only hashes of lines are sorted by URL. Each sorted partition is given the nearest pages of those before
and behind it, so the result does not depend on the number of partitions.

Defined results: NULL or empty html gives the empty text; a page without a different page on its host keeps its lines, and one inside an
article if there are fewer than ``FEWEST`` witnesses; a NULL url belongs to the host without name; repeated rows are pages like others.
"""
from __future__ import annotations

import html as entities
import itertools
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import stage

# Nearest pages that must all share a line of an article, and how many of them there must be at least.
WITNESSES, FEWEST = 4, 3
# Bits of the rows that one comparison of lines holds at once (8 MB).
DIRECT_BITS = 1 << 26

# A tag of up to 300 pieces; longer ones, and longer values with a "<" in them, are left to ``_tag_ends``.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select)\b[^<>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?>[^<>\"'=]++|=\s*+(?:\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]{0,2000}+\"|'[^']{0,2000}+'|(?![\"']))|[\"']){0,300}+)>|<[!?][^<>]*+>|[^<]++|<", re.S | re.I)
# Name of any tag that begins here.
_OPENS = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HREF = re.compile(r"\bhref\b", re.I)

_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_SPACE = frozenset(("br", "img", "input", "hr"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("html head body article main nav header footer aside form div section table figure dialog menu ul ol dl fieldset title button".split())
_DROPPED = frozenset("head nav footer aside menu dialog title button".split())
_RAW = frozenset("script style noscript template svg iframe textarea select".split())
_CONTROLS = frozenset("input select textarea button label".split())
# Words of class names, ids and roles that raise a doubt, those that take it back (wrappers and parts of articles), and the blocks of readers' comments.
_DOUBTED = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|gdpr|popup|modal|sidebar|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|"
                      r"share|sharing|social|related|recommended|newsletter|subscribe|widget|login|signup|search|pagination|pager|toolbar|skip|complementary|contentinfo|dialog")
_CLEARED = frozenset("has no not with without is hide show entry post article content main story".split())
_COMMENTS = re.compile(r"(?:(?:user|reader|post|article|all|the)[-_])?(?:comments?|replies|respond|disqus\w*|feedback|discussion|reviews)(?:[-_](?:list|section|area|body|block|item|content|text|wrap|wrapper|thread|container|[0-9]+))*")


def _kind(names: str) -> str | None:
    """``comments`` or ``doubt`` if a class name, id or role says so."""
    found = None
    for token in names.lower().split():
        if _COMMENTS.fullmatch(token):
            return "comments"
        parts = re.split("[-_]+", token)
        if _CLEARED.isdisjoint(parts) and any(_DOUBTED.fullmatch(p) for p in parts):
            found = "doubt"
    return found


def _tag_ends(page: str) -> dict[int, int]:
    """For each place where a tag begins the place behind its end; a quote counts only as the beginning of a value. Read from the end, in linear time."""
    ends, free, single, double = {}, 0, 0, 0
    for token in reversed(list(re.finditer("[\"'<>]", page))):
        at, sign = token.start(), token[0]
        if sign == ">":
            free = at + 1
        elif sign == "<":
            if free:
                ends[at] = free
            free = 0
        else:
            begins = page[max(0, at - 50):at].rstrip().endswith("=")
            before = free
            if begins:
                free = single if sign == "'" else double
            if sign == "'":
                single = before
            else:
                double = before
    return ends


def _tokens(page: str) -> Iterator[tuple[str | None, bool, str, str]]:
    """Name, whether it closes, attributes, and text of each tag or stretch of text. Tags with very many or very long attributes are found by ``_tag_ends``."""
    at, ends = 0, None
    while True:
        for token in _TOKEN.finditer(page, at):
            said = token[0]
            if said == "<" and _OPENS.match(page, token.start()):
                ends = _tag_ends(page) if ends is None else ends
                end = ends.get(token.start())
                if end:
                    name = _OPENS.match(page, token.start())
                    yield name[2], bool(name[1]), page[name.end():end - 1], ""
                    at = end
                    break
            if token[3] is not None:
                yield token[3], bool(token[2]), token[4], ""
            elif said[0] != "<" or said == "<":
                yield None, False, "", said
            elif token[1]:
                yield token[1], False, "", ""
        else:
            return


class _Reader:
    """Blocks of one page with the elements they lie in. What may be dropped is settled at the end of the page, when the elements are known:

    * a form is one only if it holds controls; what holds an article, or more than half of the page's text, is a wrapper, whatever its name;
    * readers' comments are none of the article, however long they are and whatever elements they use;
    * inside a line, a name decides only if it covers the whole line.
    """

    def __init__(self) -> None:
        self.blocks: list[tuple[str, bool, int]] = []  # text, inside an article, innermost element in doubt or -1
        self.open: list[tuple[str, bool, bool, int]] = []  # tag, dropped, article, number of the doubted element or -1
        self.tags: Counter[str] = Counter()
        self.unwanted = self.articles = 0  # numbers of open elements
        self.doubted = [-1]  # open elements in doubt
        self.elements: list[dict] = []
        self.parts: list[str] = []
        self.named = self.named_chars = self.chars = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and not self.unwanted and not (self.named_chars and self.named_chars == self.chars):
            self.blocks.append((text, self.articles > 0, self.doubted[-1]))
        self.parts, self.named_chars, self.chars = [], 0, 0

    def text(self, said: str) -> None:
        self.parts.append(said)
        size = len("".join(said.split()))
        self.chars += size
        if self.named:
            self.named_chars += size

    def mark(self, what: str) -> None:
        if self.doubted[-1] >= 0:
            self.elements[self.doubted[-1]][what] = True

    def start(self, tag: str, attributes: str) -> None:
        names = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if attributes else ""
        main = tag in ("article", "main") or names.strip().lower() == "main"
        kind = _kind(names) if names and tag not in ("html", "body") else None
        if main and kind != "comments":
            kind = None
        elif tag == "form":
            kind = "form"
        dropped = tag in _DROPPED or (tag == "header" and not self.articles)
        if main and not self.articles:
            self.mark("article")
        number = -1
        if kind:
            number = len(self.elements)
            self.elements.append({"kind": kind, "inside": self.doubted[-1], "chars": 0, "controls": False, "article": False})
            self.doubted.append(number)
        self.open.append((tag, dropped, main, number))
        self.tags[tag] += 1
        self.unwanted += dropped
        self.articles += main

    def end(self, tag: str) -> None:
        while self.tags[tag]:
            last, dropped, article, number = self.open.pop()
            self.tags[last] -= 1
            self.unwanted -= dropped
            self.articles -= article
            if number >= 0:
                self.doubted.pop()
            if last == tag:
                return

    def inline(self, tag: str, closing: bool, attributes: str) -> None:
        if closing:
            if self.tags[f"{tag} named"]:
                self.tags[f"{tag} named"] -= 1
                self.named -= 1
        elif self.named or (attributes and (names := _NAMED.findall(attributes)) and _kind(" ".join(a or b or c for a, b, c in names))):
            # Elements inside a named one count with it, so that it ends where it ends.
            self.tags[f"{tag} named"] += 1
            self.named += 1

    def feed(self, page: str) -> None:
        for tag, closing, attributes, said in _tokens(page):
            if tag is None:
                self.text(entities.unescape(said))
                continue
            tag = tag.lower()
            if tag in _CONTROLS:
                self.mark("controls")
            if tag in _RAW:
                self.parts.append(" ")
            elif tag in _INLINE:
                self.inline(tag, closing, attributes)
            elif tag in _SPACE:
                self.parts.append(" ")
            else:
                self.flush()
                self.named, self.tags = 0, Counter({t: n for t, n in self.tags.items() if not t.endswith(" named")}) if self.named else self.tags
                if closing:
                    self.end(tag)
                elif tag in _CONTAINERS or (attributes and tag not in _VOID and _NAMED.search(attributes)):
                    if tag not in _CONTAINERS and self.tags[tag]:
                        self.end(tag)  # a paragraph or item ends where the next begins
                    self.start(tag, attributes)
                elif self.tags[tag]:
                    self.end(tag)
        self.flush()

    def settled(self) -> list[tuple[str, bool]]:
        """Text of the blocks that stay, and whether each lies in an article."""
        whole = sum(len(text) for text, _, _ in self.blocks)
        for text, _, inside in self.blocks:
            if inside >= 0:
                self.elements[inside]["chars"] += len(text)
        for element in reversed(self.elements):  # what is inside counts for what is around it
            around = self.elements[element["inside"]] if element["inside"] >= 0 else {}
            for what in ("chars", "controls", "article"):
                around[what] = around.get(what, 0) + element[what]
        for element in self.elements:
            sure = element["kind"] == "comments" or (not element["article"] and 2 * element["chars"] <= whole and (element["kind"] == "doubt" or element["controls"]))
            element["gone"] = bool(sure or (element["inside"] >= 0 and self.elements[element["inside"]]["gone"]))
        return [(text, article) for text, article, inside in self.blocks if inside < 0 or not self.elements[inside]["gone"]]


def _all_blocks(page: str | None) -> tuple[list[str], list[bool], bool]:
    """Lines of a page, whether each may be text, and whether the page marks an article."""
    reader = _Reader()
    reader.feed(page or "")
    found = reader.settled()
    marked = any(article for _, article in found)
    return [t for t, _ in found], [article or not marked for _, article in found], marked


def blocks(page: str | None) -> tuple[list[str], list[bool]]:
    """Candidate lines of a page, and whether each lies in an article."""
    lines, own, marked = _all_blocks(page)
    kept = [t for t, may in zip(lines, own) if may]
    return kept, [marked] * len(kept)


def _bits(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit-parallel rows of the subsequence lengths of ``a`` with longer and longer beginnings of ``b``: a 0 where the length grows."""
    full = (1 << len(a)) - 1
    where: dict[int, int] = {}
    for k, item in enumerate(a):
        where[item] = where.get(item, 0) | 1 << k
    v = full
    yield v
    for item in b:
        u = v & where.get(item, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _grown(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of ``b`` with each beginning of ``a``."""
    *_, last = _bits(a, b)
    return [0, *itertools.accumulate(bit == "0" for bit in reversed(format(last, f"0{len(a)}b")))] if a else [0]


def _middle(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > DIRECT_BITS and len(b) > 1:
        half = len(b) // 2
        first, rest = _grown(a, b[:half]), _grown(a[::-1], b[half:][::-1])
        cut = max(range(len(a) + 1), key=lambda k: first[k] + rest[len(a) - k])
        return _middle(a[:cut], b[:half]) + [cut + k for k in _middle(a[cut:], b[half:])]
    rows = list(_bits(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
        elif not rows[j - 1] >> (i - 1) & 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence of ``a`` and ``b``: equal beginnings and ends first, what lies between by halving ``b``
    until the rows of bits of a part take ``DIRECT_BITS`` at most."""
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    most = min(len(a), len(b)) - head
    tail = next((k for k, (x, y) in enumerate(zip(reversed(a), reversed(b))) if k == most or x != y), most)
    between = _middle(a[head:len(a) - tail], b[head:len(b) - tail])
    return [*range(head), *(head + k for k in between), *range(len(a) - tail, len(a))]


_LINES = "host string, path string, class long, marked boolean, own array<boolean>, hashes array<long>, sizes array<long>"
_FIELDS = ["host", "path", "class", "marked", "own", "hashes", "sizes"]
_NEAR = "struct<path:string,class:bigint,size:bigint,hashes:array<bigint>>"


def _parsed(pages: DataFrame) -> DataFrame:
    """``row`` (a written number), ``page_id, url, lines`` and ``_LINES`` of every page; copies on one host have one class."""
    key = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for page, host in zip(batch.column("html").to_pylist(), batch.column("host").to_pylist()):
                lines, own, marked = _all_blocks(page)
                hashes = [_hash(line) for line in lines]
                kept = [line if may else "" for line, may in zip(lines, own)]  # the others only say what the pages share
                found.append((_hash(f"{host} {hashes}"), marked, own, hashes, [len(line) for line in kept], kept))
            types = (pa.int64(), pa.bool_(), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url", "host", "path")] + [pa.array([f[k] for f in found], t) for k, t in enumerate(types)],
                                             ["page_id", "url", *_FIELDS, "lines"])
    url = F.coalesce("url", F.lit(""))
    placed = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
                          F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"))
    return stage(placed.mapInArrow(run, f"page_id {key}, url string, {_LINES}, lines array<string>").withColumn("row", F.monotonically_increasing_id()), compression="zstd")


def _hash(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(text or "") - (1 << 63)


def _classes(rows: list[dict]) -> list[dict]:
    """The first row of each class."""
    seen: set[int] = set()
    return [row for row in rows if not (row["class"] in seen or seen.add(row["class"]))]


def _others(page: dict, rows: list[dict]) -> list[dict]:
    return [row for row in rows if row["class"] != page["class"]][:WITNESSES]


def lost(page: dict, before: list[dict], after: list[dict]) -> list[int]:
    """Places of the template's lines, given the pages of other classes on the host, nearest first."""
    hashes = page["hashes"]
    if not page["marked"]:
        near = before[:1] + after[:1]
        if not near:
            return []
        other = max(near, key=lambda n: len(os.path.commonprefix([n["path"], page["path"]])))
        return common(hashes, other["hashes"])
    shared, witnesses = {k for k, own in enumerate(page["own"]) if own}, 0
    for other in _classes([n for k in range(WITNESSES) for n in before[k:k + 1] + after[k:k + 1]]):
        there = set(other["hashes"])
        if witnesses == WITNESSES or not any(hashes[k] in there for k in shared):
            break
        places = [k for k in common(hashes, other["hashes"]) if page["own"][k]]
        if 2 * sum(page["sizes"][k] for k in places) > max(page["size"], other["size"]):
            continue  # a version of the same article
        witnesses += 1
        shared &= set(places)
    else:
        return sorted(shared) if witnesses >= FEWEST else []
    return sorted(shared) if witnesses == WITNESSES else []


def _ordered(hashed: DataFrame) -> DataFrame:
    """The rows by URL with ``part``, ``place`` and ``before`` (the nearest earlier pages of the part), and for each part one row of place -1
    whose ``first`` and ``last`` are the places of its pages that other parts may need, nearest to its ends first."""
    schema = f"row long, {_LINES}, part int, place long, before array<{_NEAR}>, first array<struct<place:bigint,class:bigint>>, last array<struct<place:bigint,class:bigint>>"
    end = pa.list_(pa.struct([("place", pa.int64()), ("class", pa.int64())]))
    near = pa.list_(pa.struct([("path", pa.string()), ("class", pa.int64()), ("size", pa.int64()), ("hashes", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, host, recent, first, last, given = TaskContext.get().partitionId(), 0, None, [], [], [], None
        for batch in batches:
            given, found, start = batch.schema, [], place
            for page in batch.select(["host", "path", "class", "own", "hashes", "sizes"]).to_pylist():
                if page["host"] != host:
                    host, recent = page["host"], []
                page["size"] = sum(n for n, own in zip(page["sizes"], page["own"]) if own)
                found.append(_others(page, recent))
                recent = _classes([page, *recent])[:WITNESSES + 1]
                here = {"place": place, "class": page["class"]}
                last = _classes([here, *last])[:WITNESSES + 1]
                if len(first) <= WITNESSES:
                    first = _classes([*first, here])
                place += 1
            count = place - start
            more = [pa.array([part] * count, pa.int32()), pa.array(range(start, place), pa.int64()), pa.array(found, near), pa.nulls(count, end), pa.nulls(count, end)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*given.names, "part", "place", "before", "first", "last"])
        if given:
            more = [pa.array([part], pa.int32()), pa.array([-1], pa.int64()), pa.nulls(1, near), pa.array([first], end), pa.array([last], end)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in given), *more], [*given.names, "part", "place", "before", "first", "last"])
    order = ("host", "path", "row")
    return hashed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def _across(ordered: DataFrame) -> DataFrame:
    """The rows, and for each part (``side`` 1 and 2) the nearest pages before and behind it, in the order of ``turn``: those first, then the part from its end."""
    ends = sorted(ordered.where("place < 0").select("part", "first", "last").collect())
    wanted = []
    for side, parts in ((1, ends), (2, ends[::-1])):
        near: list[dict] = []
        for end in parts:
            wanted += [(end["part"], side, turn, page["part"], page["place"]) for turn, page in enumerate(near)]
            near = _classes([{"part": end["part"], **page.asDict()} for page in end["last" if side == 1 else "first"]] + near)[:WITNESSES + 1]
    rows = ordered.where("place >= 0").drop("first", "last")
    columns = [c for c in rows.columns if c not in ("part", "place")]
    own = rows.select("part", F.lit(0).alias("side"), (-F.col("place")).alias("turn"), *columns)
    if not wanted:
        return own
    asked = ordered.sparkSession.createDataFrame(wanted, "to int, side int, turn long, part int, place long")
    given = rows.join(asked, ["part", "place"]).select(F.col("to").alias("part"), "side", (F.col("turn") - (1 << 62)).alias("turn"), *columns)
    return own.unionByName(given)


def _shared_lines(hashed: DataFrame) -> DataFrame:
    """``row, kept`` (a mark for each line) of the pages that lose lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = host = None
        recent, ends = [], {1: [], 2: []}
        for batch in batches:
            out = []
            for page in batch.to_pylist():
                if page["part"] != part:
                    part, host, recent, ends = page["part"], None, [], {1: [], 2: []}
                page["size"] = sum(n for n, own in zip(page["sizes"], page["own"]) if own)
                if page["side"]:
                    ends[page["side"]].append(page)
                    continue
                if page["host"] != host:
                    host, recent = page["host"], []
                before, after = ([n for n in ends[side] if n["host"] == host] for side in (1, 2))
                deleted = set(lost(page, _others(page, _classes(page["before"] + before)), _others(page, _classes(recent + after))))
                if deleted:
                    out.append((page["row"], [own and k not in deleted for k, own in enumerate(page["own"])]))
                del page["before"]
                recent = _classes([page, *recent])[:WITNESSES + 1]
            if out:
                rows, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kept, pa.list_(pa.bool_()))], ["row", "kept"])
    rows = _across(stage(_ordered(hashed)))
    return rows.repartitionByRange("part").sortWithinPartitions("part", "turn").mapInArrow(run, "row long, kept array<boolean>")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    parsed = _parsed(pages.select("page_id", "url", "html"))
    deleted = stage(_shared_lines(parsed.where(F.exists("own", lambda may: may)).select("row", *_FIELDS)))
    marks = F.coalesce("kept", "own")
    text = F.array_join(F.filter("lines", lambda _, k: F.get(marks, k)), "\n")
    return parsed.select("row", "page_id", "url", "lines", "own").join(deleted, "row", "left").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
