"""Ordered per-group computations that stay parallel when one group holds a large share of the rows.

A plain window sends a whole group to one task. Groups of ordinary size (all real games) are computed exactly like that.
Groups above ``MAX_GROUP_ROWS`` are found first by a pre-aggregated count and carry a ``chunk`` column that cuts them, in
order, into bounded pieces. A scan then works inside (group, chunk), reduces every chunk to one summary row, scans the
summaries, and joins the carried values back. Chunks are numbered from the counted rows of a group, and rows that share a
place (their second) lie in one chunk unless that place alone exceeds the bound; the rows are stored in buckets of the chunk,
so only summaries travel. A chunk follows from the row and the counts, so a lost executor recomputes the same pieces.

A scan writes its carried values only, not the rows. The rows of a chain of scans are computed again for every summary, from
the last place where they were stored (``settled``), with the columns which that summary needs.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.shared import stage, stage_by
from .verbs import join_null_safe, nulls_last

CHUNK, CUT = "chunk", "chunk_cut"  # CUT: the rows of this place lie in several chunks
MAX_GROUP_ROWS = 20_000
ROWS_PER_TASK = 40_000  # a chain of scans keeps some twenty sorts of a task's rows in memory at once


class Step(NamedTuple):
    kind: str
    value: Column


def running_sum(value) -> Step:
    """Sum of the rows up to and including this one. The value must not be NULL."""
    return Step("running_sum", value)


def row_count() -> Step:
    """Number of the row inside its group, from 1."""
    return Step("running_sum", F.lit(1).cast("bigint"))


def fill_down(value) -> Step:
    """Last non-NULL value at or before this row."""
    return Step("fill_down", value)


def fill_up(value) -> Step:
    """First non-NULL value at or after this row."""
    return Step("fill_up", value)


def previous(value) -> Step:
    return Step("previous", value)


def following(value) -> Step:
    return Step("following", value)


def group_sum(value) -> Step:
    """Sum over the whole group, on every row."""
    return Step("group_sum", value)


def group_max(value) -> Step:
    return Step("group_max", value)


def group_min(value) -> Step:
    return Step("group_min", value)


def group_last(value) -> Step:
    """Last non-NULL value of the whole group, on every row."""
    return Step("group_last", value)


class EventLog(NamedTuple):
    """A log as one frame of ordinary groups and, only if there are any, one frame of large groups cut into chunks."""

    parts: tuple[DataFrame, ...]
    tasks: int | None = None  # partitions that bound the rows of a task, by the counted rows

    def apply(self, operator: Callable[..., DataFrame], *args, **kwargs) -> EventLog:
        return EventLog(tuple(operator(part, *args, **kwargs) for part in self.parts), self.tasks)

    def frame(self) -> DataFrame:
        whole = self.parts[0].drop(CHUNK, CUT)
        for part in self.parts[1:]:
            whole = whole.unionByName(part.drop(CHUNK, CUT))
        return whole

    def stage(self) -> EventLog:
        return EventLog(tuple(stage(part) for part in self.parts), self.tasks)

    def stored_by(self, key: str) -> EventLog:
        """Staged with the ordinary groups in buckets of ``key``, and large groups in buckets of the chunk: a bucket of ``key`` would bring each back into
        one task."""
        return EventLog(tuple(_stored_by_chunk(part) if CHUNK in part.columns else stage_by(part, key, self.tasks) for part in self.parts), self.tasks)


def _stored_by_chunk(part: DataFrame) -> DataFrame:
    tasks = part.schema[CHUNK].metadata["tasks"]
    return stage_by(part.repartition(tasks, CHUNK), CHUNK, tasks)


def settled(part: DataFrame) -> DataFrame:
    """Store large groups at this place of a chain, so that the summaries of later scans begin here; ordinary groups are left as they are."""
    return _stored_by_chunk(part) if CHUNK in part.columns else part


def beside(side: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Partition a per-group table like its events, so a join on finer keys shuffles the small side only.

    For split groups a row is given to every chunk of its group, and the chunk belongs to the keys of the join (``chunked``).
    """
    if CHUNK not in events.columns:
        return side.repartition(key)
    return side.join(events.select(key, CHUNK).distinct(), key)


def chunked(keys: Sequence[str], events: DataFrame) -> list[str]:
    """The keys to join events with a table that is ``beside`` them."""
    return [*keys, *(c for c in (CHUNK,) if c in events.columns)]


def split_large_groups(df: DataFrame, keys: Sequence[str], chunk: Column, max_rows: int = MAX_GROUP_ROWS,
                       counted: DataFrame | None = None) -> EventLog:
    """Separate the groups with more than ``max_rows`` rows and cut them by ``chunk``.

    ``chunk`` must never decrease along the order of later scans and must bound the rows per value. Counting reads only
    the key columns (of ``counted``, if the frame itself is costly to compute) and at most rows / max_rows keys come out
    of it; the number of rows and the largest group are the only things asked here. Ordinary groups are dealt over as many
    partitions as keep a task at about ``ROWS_PER_TASK`` rows, however many rows there are.
    """
    counts = (df if counted is None else counted).groupBy(*keys).count()
    seen = counts.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    tasks = max(math.ceil((seen.rows or 0) / ROWS_PER_TASK), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if (seen.most or 0) <= max_rows:
        return EventLog((df.repartition(tasks, *keys),), tasks)
    df = stage(df)  # read by both parts, and counted
    large = stage(counts.where(F.col("count") > max_rows).select(*keys))
    return EventLog((join_null_safe(df, large, keys, "left_anti").repartition(tasks, *keys),
                     _cut(join_null_safe(df, large, keys, "left_semi").withColumn(CHUNK, chunk), list(keys), max_rows, tasks)), tasks)


def _cut(df: DataFrame, keys: list, max_rows: int, tasks: int) -> DataFrame:
    """Number the chunks of every group by the rows before them. The places of a chunk are its coarse columns (``order_chunk``).

    The number carries a hash of the group in its upper half: it rises along the order of a group, differs between groups and is never NULL, so rows
    are partitioned, stored and joined by it alone.
    """
    fields = df.schema[CHUNK].dataType.names
    place = [F.col(f"{CHUNK}.{f}") for f in fields[:-2]]  # without the number and its block
    pieces = df.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(along), F.lit(0)))
    at = Window.partitionBy(*keys, *place)
    pieces = pieces.withColumns({CUT: F.sum("__n").over(at) > max_rows, "__start": F.min("__before").over(at)})
    number = F.floor(F.when(F.col(CUT), F.col("__before")).otherwise(F.col("__start")) / max_rows)
    pieces = pieces.select(*keys, CHUNK, CUT, (F.shiftleft(F.hash(*keys).cast("bigint"), 32) + number).alias("__number"))
    about = {"tasks": tasks, "place": [*keys, *fields[1:-2:2]] if place else []}
    numbered = join_null_safe(df, pieces, [*keys, CHUNK], "left").withColumn(CHUNK, F.col("__number").alias(CHUNK, metadata=about)).drop("__number")
    stored = _stored_by_chunk(numbered)
    about["cut"] = not stored.where(CUT).isEmpty()
    return stored.withColumn(CHUNK, F.col(CHUNK).alias(CHUNK, metadata=about))


def order_chunk(*coarse: str, number: str, rows: int = MAX_GROUP_ROWS) -> Column:
    """Chunk for the order (coarse columns, number), where ``number`` is unique inside a group."""
    return F.struct(*[column for c in coarse for column in (F.col(c).isNull().alias(f"{c}_unknown"), F.col(c).alias(c))],
                    F.col(number).isNull().alias("unnumbered"), F.floor(F.col(number) / rows).alias("block"))


class _Windows:
    """The window specifications of one scan, made once and only if a step needs them."""

    def __init__(self, keys: list, order: list, before: int = Window.currentRow):
        self.keys, self.order, self.span = keys, order, (Window.unboundedPreceding, before)

    @cached_property
    def whole(self):
        return Window.partitionBy(*self.keys)

    @cached_property
    def forward(self):
        return self.whole.orderBy(*[F.col(o).asc_nulls_last() for o in self.order])

    @cached_property
    def running(self):
        return self.forward.rowsBetween(*self.span)

    @cached_property
    def backward(self):
        # A frame that ends at the last row is quadratic in Spark, so it is read as a running frame in reverse order.
        return self.whole.orderBy(*[F.col(o).desc_nulls_first() for o in self.order]).rowsBetween(*self.span)

    def value(self, kind: str, value: Column) -> Column:
        if kind == "running_sum":
            return F.sum(value).over(self.running)
        if kind == "fill_down":
            return F.last(value, ignorenulls=True).over(self.running)
        if kind == "fill_up":
            return F.last(value, ignorenulls=True).over(self.backward)
        if kind == "previous":
            return F.lag(value).over(self.forward)
        if kind == "following":
            return F.lead(value).over(self.forward)
        if kind == "group_last":
            return F.last(value, ignorenulls=True).over(
                self.forward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        aggregate = {"group_sum": F.sum, "group_max": F.max, "group_min": F.min}[kind]
        return aggregate(value).over(self.whole)


def _summary(step: Step, order: list) -> Column:
    """One value per chunk."""
    position = nulls_last(*order)
    if step.kind in ("previous", "following"):
        pick = F.max_by if step.kind == "previous" else F.min_by
        return pick(F.struct(step.value.alias("v")), position)
    if step.kind in ("fill_down", "fill_up", "group_last"):
        pick = F.min_by if step.kind == "fill_up" else F.max_by
        return pick(step.value, F.when(step.value.isNotNull(), position))
    return {"group_max": F.max, "group_min": F.min}.get(step.kind, F.sum)(step.value)


def _combined(step: Step, local: Column, carry: Column) -> Column:
    if step.kind == "running_sum":
        return local + F.coalesce(carry, F.lit(0))
    if step.kind in ("fill_down", "fill_up"):
        return F.coalesce(local, carry)
    if step.kind in ("previous", "following"):
        return F.coalesce(local, carry)["v"]
    return F.coalesce(carry, local)  # the carry is that of the whole group


def scan(df: DataFrame, group: Sequence[str], order: Sequence[str], steps: dict[str, Step]) -> DataFrame:
    """Add one column per step, computed in ``order`` inside every group."""
    group, order = list(group), list(order)
    cut = CHUNK in df.columns
    keys, about = group + [CHUNK for _ in range(cut)], df.schema[CHUNK].metadata if cut else {}
    # Groups inside a place lie in one chunk, but for the places that are cut.
    inside = cut and bool(about["place"]) and set(about["place"]) <= set(group)
    windows = _Windows(keys, order)
    if not cut or (inside and not about["cut"]):
        return df.withColumns({name: windows.value(step.kind, step.value) for name, step in steps.items()})

    wrapped = {name: Step(step.kind, F.struct(step.value.alias("v"))) if step.kind in ("previous", "following") else step
               for name, step in steps.items()}
    carries = _Windows(group, [CHUNK], before=-1)
    local = df.withColumns({f"__local_{name}": windows.value(step.kind, step.value) for name, step in wrapped.items()})
    split = df.where(CUT) if CUT in df.columns and inside else df
    summary = split.groupBy(*keys).agg(*[_summary(step, order).alias(f"__part_{name}") for name, step in steps.items()])
    # Written, so that the plan of a chain grows by one small table for each scan.
    carry = stage(summary.select(
        *[F.col(key).alias(f"__key_{key}") for key in keys],
        *[carries.value(step.kind, F.col(f"__part_{name}")).alias(f"__carry_{name}") for name, step in steps.items()]))
    same = F.col(CHUNK) == F.col(f"__key_{CHUNK}")  # never NULL: both sides meet by the partitioning of the rows
    for key in group:
        same = same & F.col(key).eqNullSafe(F.col(f"__key_{key}"))
    # A task has far fewer carried values than rows: they are looked up, and the rows are not sorted once more to meet them.
    joined = local.join(carry.hint("shuffle_hash"), same, "left")
    kept = [F.col(c) for c in df.columns if c not in steps]
    return joined.select(*kept, *[_combined(step, F.col(f"__local_{name}"), F.col(f"__carry_{name}")).alias(name) for name, step in steps.items()])


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], blocks: Sequence[tuple[str, Column]],
                name: str) -> DataFrame:
    """Dense numbers 1..n inside a group that may be far larger than one task.

    ``blocks`` cut the order from coarse to fine; rows are numbered inside the finest block and shifted by counts of the
    blocks before it, which are summed level by level.
    """
    group, labels = list(group), [label for label, _ in blocks]
    df = stage(df.withColumns(dict(blocks)))
    offsets = _offsets(df.groupBy(*group, *labels).agg(F.count(F.lit(1)).alias("__n")), group, labels)
    inside = F.row_number().over(Window.partitionBy(*group, *labels).orderBy(*order))
    return (df.withColumn(name, inside).join(offsets, group + labels, "left")
            .withColumn(name, F.col(name) + F.col("__offset")).drop("__offset", *labels))


def _offsets(counts: DataFrame, group: list, labels: list) -> DataFrame:
    outer, last = group + labels[:-1], labels[-1]
    before = Window.partitionBy(*outer).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    if len(labels) == 1:
        return inside.drop("__n")
    coarse = _offsets(counts.groupBy(*outer).agg(F.sum("__n").alias("__n")), group, labels[:-1])
    return (inside.join(coarse.withColumnRenamed("__offset", "__coarse"), outer)
            .withColumn("__offset", F.col("__offset") + F.col("__coarse")).drop("__n", "__coarse"))
