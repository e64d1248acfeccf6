"""Joins on time: the last row at or before a moment, and overlapping intervals.

NULL keys are a group like others, as everywhere in this library; a NULL time or bound is never matched.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ..sources.shared import stage
from .parts import AT, PART, ordered_parts
from .verbs import join_null_safe

MAX_BIN_ROWS = 20_000


def _number(df: DataFrame, column: str) -> Column:
    """Seconds of a timestamp, or the number itself, as double."""
    kind = df.schema[column].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")) / 1e6
    return F.col(column).cast("double")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, values: Sequence[str], *,
              ties: Sequence[str] = (), tolerance: float | None = None, prefix: str = "last_") -> DataFrame:
    """Every row of ``left`` with ``values`` and the time of the last row of ``right`` of its keys at or before its time.

    Among rows of one time the last in the order of ``ties``, then of ``values``, wins. A match further back than ``tolerance``
    (seconds, or the unit of a numeric time) is none. Rows without a match, or without a time, keep NULLs.

    Both sides are sorted together once, keys first, over range partitions, so neither a hot key nor a hot moment meets in one task. The last row
    is filled down inside a partition, and what a partition begins with comes from one summary row for each partition and key.
    """
    keys, taken = list(keys), list(dict.fromkeys([*values, right_time]))
    order = list(dict.fromkeys([*ties, *values]))
    asked = left.select(*[F.col(k).alias(f"__k_{k}") for k in keys], _number(left, left_time).alias("__time"), F.lit(1).alias("__side"),
                        F.struct(*left.columns).alias("__left"))
    known = right.where(F.col(right_time).isNotNull()).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], _number(right, right_time).alias("__time"), F.lit(0).alias("__side"),
        *[F.col(c).alias(f"__o_{c}") for c in order], F.struct(_number(right, right_time).alias("__when"), *taken).alias("__right"))
    named = [f"__k_{k}" for k in keys]
    rows = ordered_parts(known.unionByName(asked, allowMissingColumns=True), [*named, "__time", "__side", *[f"__o_{c}" for c in order]])
    inside = W.partitionBy(PART, *named).orderBy(AT).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.withColumn("__found", F.last("__right", ignorenulls=True).over(inside)).where("__side = 1").select(PART, *named, "__time", "__left", "__found")
    ends = rows.groupBy(PART, *named).agg(F.max_by("__right", F.when(F.col("__side") == 0, F.col(AT))).alias("__end"))
    before = W.partitionBy(*named).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(PART, *named, F.last("__end", ignorenulls=True).over(before).alias("__carried"))
    joined = join_null_safe(local, carried, [PART, *named], "left")
    match = F.coalesce("__found", "__carried")
    near = F.col("__time").isNotNull() if tolerance is None else F.col("__time") - match["__when"] <= tolerance
    return joined.select("__left.*", F.when(near, match).alias("__match")).select(
        *left.columns, *[F.col(f"__match.{c}").alias(f"{prefix}{c}") for c in taken])


def _levelled(df: DataFrame, start: str, end: str, width: float, keys: Sequence[str]) -> DataFrame:
    """Valid intervals as numbers, each on the level whose bins are about as long: level n has bins of ``width`` times 2**n."""
    begin, stop = _number(df, start), _number(df, end)
    rows = df.select(F.struct(*df.columns).alias("__row"), *[F.col(k).alias(f"__k_{k}") for k in keys], begin.alias("__from"), stop.alias("__to"))
    long = F.col("__to") - F.col("__from")
    return rows.where("__from <= __to").withColumns({"__level": F.when(long <= width, 0).otherwise(F.ceil(F.log2(long / width))).cast("int"), "__no": F.monotonically_increasing_id()})


def _binned(rows: DataFrame, levels: list[int], width: float) -> DataFrame:
    """A row for each bin of the interval on its own level (``__home``) and on the higher levels of the other side."""
    own = rows.withColumn("__at", F.explode(F.filter(F.array_union(F.array("__level"), F.array(*map(F.lit, levels)).cast("array<int>")), lambda n: n >= F.col("__level"))))
    size = F.lit(width) * F.pow(F.lit(2.0), F.col("__at"))
    return own.withColumns({"__home": F.col("__at") == F.col("__level"), "__bin": F.explode(F.sequence(F.floor(F.col("__from") / size), F.floor(F.col("__to") / size)))})


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], width: float, *,
                  prefix: str = "other_", max_bin_rows: int = MAX_BIN_ROWS) -> DataFrame:
    """All pairs of rows with equal keys whose closed intervals overlap (a moment is an interval of length 0); the keys appear once.

    An equi-join on keys and time bins. Intervals longer than ``width`` go to a level of longer bins, so each has at most three there, and visit
    only the higher levels that the other side uses; on one level at least one partner must be at home, so a pair meets on one level. Of the bins
    that both cover there, only the first gives the pair. Bins with more than ``max_bin_rows`` rows of the left side are dealt over several tasks, and the rows
    of the right side are handed to each of them. An interval with a NULL bound, or one that ends before it begins, has no pairs.
    """
    keys = list(keys)
    one, two = stage(_levelled(left, *left_span, width, keys)), stage(_levelled(right, *right_span, width, keys))
    levels_one, levels_two = ([r[0] for r in side.select("__level").distinct().collect()] for side in (one, two))  # at most some 60
    named = [f"__k_{k}" for k in keys]
    where = [*named, "__at", "__bin"]
    ours, theirs = _binned(one, levels_two, width), _binned(two, levels_one, width)
    crowded = stage(ours.groupBy(*where).count().where(F.col("count") > max_bin_rows).select(*where, F.ceil(F.col("count") / max_bin_rows).cast("int").alias("__deals")))
    shares = F.coalesce("__deals", F.lit(1))
    ours = join_null_safe(ours, crowded, where, "left").withColumn("__deal", F.pmod(F.xxhash64("__no"), shares).cast("int")).drop("__deals")
    theirs = join_null_safe(theirs, crowded, where, "left").withColumn("__deal", F.explode(F.sequence(F.lit(0), shares - 1))).drop("__deals")
    theirs = theirs.withColumnsRenamed({c: f"{c}_two" for c in ("__row", "__from", "__to", "__level", "__home", "__no")})
    met = join_null_safe(ours, theirs, [*where, "__deal"], "inner")
    start = F.greatest("__from", "__from_two")
    first = F.floor(start / (F.lit(width) * F.pow(F.lit(2.0), F.col("__at")))) == F.col("__bin")
    overlap = (F.col("__from") <= F.col("__to_two")) & (F.col("__from_two") <= F.col("__to"))
    pairs = met.where((F.col("__home") | F.col("__home_two")) & overlap & first)
    others = [c for c in right.columns if c not in keys]
    return pairs.select(*[F.col(f"__row.{c}").alias(c) for c in left.columns], *[F.col(f"__row_two.{c}").alias(f"{prefix}{c}") for c in others])
