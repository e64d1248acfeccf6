"""Merkle manifest of a dataset with one multiproof for each leaf partition (octopus).

Every row is a leaf, every language a binary tree over its leaves by doc_id, and the subroots are the leaves of one more tree, whose root names
the dataset. A node that is alone in its run is hashed alone.

* **Building.** Leaves are range-sorted and written once; their places come from counts of the sorted parts. Blocks of 2**``LEVELS`` leaves are
  hashed up in one task each, then blocks of their roots, and so on: three rounds for 10**9 leaves. Only nodes from block roots up are stored.
* **Proving.** A leaf partition is ``SPAN`` neighbouring blocks. ``missing`` gives the union of the node coordinates its leaves' proofs need and
  that it cannot derive itself: at most two a level. They are fetched in one join, the nodes inside are derived from the partition's own leaves, and
  the proof of each leaf is read off these levels, without another exchange.

Nodes near a root are wanted by very many partitions, so they are handed out in copies, each for ``HANDED`` partitions.

Defined results: a NULL language is a tree of its own and comes first; rows without doc_id come first in their tree; rows that share language and
doc_id are leaves in the order of their digests, repeated rows each a leaf; NULL fields and empty texts have digests like others; an empty table gives
an empty result; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.shared import stage

LEVELS, SPAN, HANDED = 10, 5, 1024
TOP = "^"  # name of the tree over the subroots; those of languages are empty (NULL) or begin with a colon
NODE = "tree string, level int, place long, digest string"
_NAMES = ["tree", "level", "place", "digest"]
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return (leaves - 1).bit_length() if leaves else 0


def width(leaves: int, level: int) -> int:
    """Number of nodes on a level."""
    return -(-leaves >> level)


def parents(nodes: list[str]) -> list[str]:
    """Digests of runs of two; the last run may be one node."""
    return [sha256("".join(nodes[k:k + 2]).encode()).hexdigest() for k in range(0, len(nodes), 2)]


def missing(known: Iterable[int], leaves: int, level: int = 0) -> list[tuple[int, int]]:
    """Coordinates ``(level, place)`` of the nodes that the proofs of the known nodes of a level need and that these cannot derive."""
    now, out = set(known), []
    for at in range(level, height(leaves)):
        count = width(leaves, at)
        out += sorted((at, k ^ 1) for k in now if k ^ 1 not in now and k ^ 1 < count)
        now = {k >> 1 for k in now}
    return out


def derive(first: int, nodes: list[str], leaves: int, fetched: dict[tuple[int, int], str], level: int = 0) -> list[tuple[int, list[str]]]:
    """For each level up to the root: the place of the first node at hand and all nodes at hand there, own and fetched."""
    out = []
    for at in range(level, height(leaves)):
        nodes = list(nodes)
        if first & 1:
            first -= 1
            nodes.insert(0, fetched[at, first])
        last = first + len(nodes) - 1
        if not last & 1 and last + 1 < width(leaves, at):
            nodes.append(fetched[at, last + 1])
        out.append((first, nodes))
        first, nodes = first >> 1, parents(nodes)
    return [*out, (first, nodes)]


def path(place: int, leaves: int, levels: list[tuple[int, list[str]]]) -> list[tuple[int, str]]:
    """For each level ``(side, sibling)`` of the node above or at ``place``: side 0 if the sibling stands left, 1 if right, 2 if there is none."""
    out = []
    for at, (first, nodes) in enumerate(levels[:-1]):
        other = (place >> at) ^ 1
        out.append((other & 1, nodes[other - first]) if other < width(leaves, at) else (2, ""))
    return out


def fold(leaf: str, steps: Iterable[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for side, other in steps:
        leaf = digest_of(other, leaf) if side == 0 else digest_of(leaf, other)
    return leaf


# ---- leaves

def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def leaves_of(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``tree, doc_id, leaf, claimed``: the digest of every row; ``claimed`` (a digest, mostly NULL) is one to be tried in its place."""
    return docs.select(F.coalesce(F.concat(F.lit(":"), "lang"), F.lit("")).alias("tree"), "doc_id", leaf_digest(*map(F.col, FIELDS)).alias("leaf"),
                       (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"))


def tampered(every: int = 7) -> Column:
    """Digest of the row with one character more, where ``every`` divides the crc32 of its doc_id."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1)
    return F.when((F.crc32(F.col("doc_id").cast("string")) % every == 0) & F.col("n_chars").isNotNull(),
                  leaf_digest(*[more if c == "n_chars" else F.col(c) for c in FIELDS]))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with ``tree``) with ``place``, the number of the row inside its tree from 0, and ``leaves``, the size of the tree.

    A written number tells equal rows apart, so copies spread over the sorted parts; a part knows its rows' places but for the rows of
    its tree in earlier parts, which are added up from one count for each part and tree.
    """
    order = ("tree", *order, "__row")
    rows = stage(rows.withColumn("__row", F.monotonically_increasing_id()))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ordered = stage(ordered.withColumn("__part", F.shiftright("__at", 33)).drop("__row"))
    runs = ordered.groupBy("tree", "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    tree = W.partitionBy("tree")
    runs = runs.select("tree", "__part", (F.col("__first") - F.coalesce(F.sum("__n").over(tree.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("__shift"),
                       F.sum("__n").over(tree).alias("leaves"))
    return ordered.join(runs, ["tree", "__part"]).withColumn("place", F.col("__at") - F.col("__shift")).drop("__at", "__part", "__shift")


# ---- building

def _rise(nodes: DataFrame, level: int, low: bool) -> DataFrame:
    """Nodes above those of one ``level`` (``tree, leaves, place, digest``), up to the next block root or the root; ``low``: only these."""
    def run(_, block):
        leaves, tree = block["leaves"][0].as_py(), block["tree"][0].as_py()
        block = block.sort_by("place")
        first, digests, rows = block["place"][0].as_py(), block["digest"].to_pylist(), []
        for at in range(level, min(level + LEVELS, height(leaves))):
            first, digests = first >> 1, parents(digests)
            if not low or at + 1 == min(level + LEVELS, height(leaves)):
                rows += [(tree, at + 1, first + k, d, leaves) for k, d in enumerate(digests)]
        if low and not rows:  # one leaf
            rows = [(tree, level, first, digests[0], leaves)]
        columns = zip(*rows) if rows else ((),) * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()))], [*_NAMES, "leaves"])
    blocks = nodes.select("tree", "leaves", "place", "digest").withColumn("block", F.shiftright("place", LEVELS))
    return stage(blocks.groupBy("tree", "block").applyInArrow(run, f"{NODE}, leaves long"))


def build(nodes: DataFrame, low: bool = True) -> DataFrame:
    """``tree, level, place, digest, leaves`` of all nodes from the block roots up (or, unless ``low``, above the leaves), given ``tree, leaves, place, digest``."""
    most = nodes.agg(F.max("leaves")).first()[0] or 0
    store = _rise(nodes, 0, low)
    above, level = store, LEVELS
    while level < height(most):
        above = _rise(above.where((F.col("level") == level) & (F.col("leaves") > (1 << level))), level, False)
        store, level = store.unionByName(above), level + LEVELS
    return store


def _subroots(store: DataFrame) -> DataFrame:
    return store.groupBy("tree").agg(F.max("leaves").alias("leaves"), F.max_by("digest", "level").alias("subroot"))


# ---- proving

_STEPS = "array<struct<level:int,place:bigint,digest:string>>"


def _wanted(rows: DataFrame, low: int) -> DataFrame:
    """``rows`` (``tree, first, last, leaves``) with one row for each missing coordinate of the nodes ``first`` to ``last`` of level ``low``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for k, row in enumerate(batch.to_pylist()):
                own = missing(range(row["first"], row["last"] + 1), row["leaves"], low)
                at += [k] * len(own)
                found += own
            levels, places = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, pa.array(levels, pa.int32()), pa.array(places, pa.int64())],
                                             [*batch.schema.names, "level", "place"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, level int, place long")


def _fetched(spans: DataFrame, store: DataFrame) -> DataFrame:
    """``tree, span, steps``: the stored nodes that each leaf partition lacks."""
    wanted = _wanted(spans, LEVELS).withColumn("hand", F.floor(F.col("span") / HANDED)).drop("first", "last", "leaves")
    # The partitions that want a node hold the blocks below its sibling.
    reach, shift = SPAN * HANDED, "shiftleft({0}, level - %d)" % LEVELS
    first, last = F.expr(shift.format("(place ^ 1L)")), F.expr(shift.format("((place ^ 1L) + 1L)")) - 1
    handed = store.where(F.col("level") >= LEVELS).select("tree", "level", "place", "digest",
                                                          F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach))).alias("hand"))
    return wanted.join(handed, ["tree", "level", "place", "hand"]).groupBy("tree", "span").agg(F.collect_list(F.struct("level", "place", "digest")).alias("steps"))


def _tops(subroots: DataFrame) -> DataFrame:
    """``tree, leaves, subroot, at, trees, top, root`` for every tree: its place among ``trees``, and what it lacks to reach the root."""
    trees = stage(placed(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.col("leaves").alias("size"), "subroot"), "name")
                  .select("tree", "name", "size", "subroot", F.col("leaves").alias("trees"), F.col("place").alias("at")))
    nodes = trees.select("tree", F.col("trees").alias("leaves"), F.col("at").alias("place"), F.col("subroot").alias("digest"))
    leaf = nodes.select("tree", F.lit(0).alias("level"), "place", "digest")
    store = stage(leaf.unionByName(build(nodes, low=False).select(*_NAMES)))
    wanted = _wanted(trees.select("name", F.col("at").alias("first"), F.col("at").alias("last"), F.col("trees").alias("leaves")), 0)
    steps = wanted.join(store, ["level", "place"]).groupBy("name").agg(F.collect_list(F.struct("level", "place", "digest")).alias("top"))
    root = store.agg(F.max_by("digest", "level")).first()[0]
    return trees.drop("tree").join(steps, "name", "left").select(
        F.col("name").alias("tree"), "subroot", "at", "trees", F.coalesce("top", F.array().cast(_STEPS)).alias("top"), F.lit(root).cast("string").alias("root"))


def proofs(leaves: DataFrame, siblings: bool = True) -> DataFrame:
    """For each of ``leaves`` (from ``leaves_of``): ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` and, if asked for, ``siblings``.

    ``folded_root`` is recomputed from the claimed leaf, or else from the leaf itself, and its siblings.
    """
    key = leaves.schema["doc_id"].dataType.simpleString()
    rows = stage(placed(leaves, "doc_id", "leaf"))
    store = build(rows.select("tree", "leaves", "place", F.col("leaf").alias("digest")))
    tops = stage(_tops(_subroots(store)))
    reach = SPAN << LEVELS
    rows = rows.withColumn("span", F.floor(F.col("place") / reach))
    sizes = store.groupBy("tree").agg(F.max("leaves").alias("leaves"))
    spans = sizes.select("tree", "leaves", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("leaves") - 1) / reach))).alias("span"))
    blocks = F.floor((F.col("leaves") - 1) / (1 << LEVELS))
    spans = spans.select("tree", "leaves", "span", (F.col("span") * SPAN).alias("first"), F.least((F.col("span") + 1) * SPAN - 1, blocks).alias("last"))
    given = spans.join(_fetched(spans, store), ["tree", "span"], "left").join(tops, "tree").select("tree", "span", "steps", "subroot", "at", "trees", "top", "root")

    def run(_, own, given):
        own = own.sort_by("place")
        near = given.slice(0, 1).to_pylist()[0]
        count, first = own["leaves"][0].as_py(), own["place"][0].as_py()
        fetched = {(s["level"], s["place"]): s["digest"] for s in near["steps"] or []}
        levels = derive(first, own["leaf"].to_pylist(), count, fetched)
        over = derive(near["at"], levels[-1][1], near["trees"], {(s["level"], s["place"]): s["digest"] for s in near["top"]})
        above = path(near["at"], near["trees"], over)
        root = over[-1][1][0]
        # Sibling texts from the root down: those of a node are its own sibling's before those of its parent.
        said = {0: "".join(d for _, d in above)}
        for at in range(len(levels) - 2, -1, -1):
            start, nodes = levels[at]
            said = {k: (nodes[(k ^ 1) - start] if (k ^ 1) - start < len(nodes) else "") + said[k >> 1] for k in range(start, start + len(nodes))}
        proof, folded, shown = [], [], []
        for place, claim in enumerate(own["claimed"].to_pylist(), first):
            proof.append(sha256(said[place].encode()).hexdigest())
            folded.append(root if claim is None else fold(claim, [*path(place, count, levels), *above]))
            if siblings:
                shown.append([said[place][k:k + 64] for k in range(0, len(said[place]), 64)])
        n = len(proof)
        columns = {"doc_id": own["doc_id"], "leaf": own["leaf"], "subroot": pa.array([levels[-1][1][0]] * n), "root": pa.array([near["root"]] * n),
                   "proof_sha256": pa.array(proof), "folded_root": pa.array(folded), "verified": pa.array([f == near["root"] for f in folded])}
        return pa.table(columns | ({"siblings": pa.array(shown, pa.list_(pa.string()))} if siblings else {}))
    schema = f"doc_id {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + (", siblings array<string>" if siblings else "")
    return rows.groupBy("tree", "span").cogroup(given.groupBy("tree", "span")).applyInArrow(run, schema)


# ---- the same in SQL

def statement() -> str:
    """``proofs`` of the leaves of ``documents`` with tampered claims, level by level for whole trees."""
    def leaf(n_chars: str) -> str:
        fields = (n_chars if c == "n_chars" else c for c in FIELDS)
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END" for c in fields) + ")"
    crc = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
    rise = """SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (n + 1) // 2 FROM {0} WHERE n > 1 GROUP BY tree, level, place // 2, n"""
    steps = """SELECT r, list(CASE WHEN s.digest IS NULL THEN 'N' WHEN s.place % 2 = 0 THEN 'L' || s.digest ELSE 'R' || s.digest END ORDER BY level) AS steps
  FROM {1} JOIN (SELECT DISTINCT tree, level FROM {0} WHERE n > 1) USING (tree) LEFT JOIN {0} s ON s.tree = {1}.tree AND s.level = levels.level AND s.place = xor({1}.place >> levels.level, 1) GROUP BY r"""
    steps = steps.replace("WHERE n > 1) USING (tree)", "WHERE n > 1) levels ON levels.tree = {1}.tree").replace("ORDER BY level", "ORDER BY levels.level")
    return f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, coalesce(':' || lang, '') AS tree, doc_id, {leaf("n_chars")} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND {crc} % 7 = 0 THEN {leaf("n_chars::HUGEINT + 1")} END AS claimed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows),
nodes(tree, level, place, digest, n) AS (SELECT tree, 0, place, leaf, count(*) OVER (PARTITION BY tree) FROM leaves UNION ALL {rise.format("nodes")}),
trees AS (SELECT row_number() OVER (ORDER BY tree) AS r, '' AS tree, tree AS name, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE n = 1),
tops(tree, level, place, digest, n) AS (SELECT tree, 0, place, subroot, count(*) OVER () FROM trees UNION ALL {rise.format("tops")}),
low AS ({steps.format("nodes", "leaves")}), high AS ({steps.format("tops", "trees")}),
joined AS (SELECT doc_id, leaf, claimed, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, coalesce(low.steps, []) || coalesce(high.steps, []) AS steps
  FROM leaves JOIN trees ON trees.name = leaves.tree LEFT JOIN low ON low.r = leaves.r LEFT JOIN high ON high.r = trees.r),
folded AS (SELECT *, list_reduce(list_prepend(coalesce(claimed, leaf), steps), lambda a, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:]) ELSE sha256(a) END) AS folded_root FROM joined)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(list_filter(steps, lambda s: s <> 'N'), lambda s: s[2:]), ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded"""
