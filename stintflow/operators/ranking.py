"""Ranks over a whole table and the first rows of every group, without a task that holds a whole order or a whole group."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..sources.shared import stage
from .parts import AT, PART, ascending, ordered_parts
from .scan import nulls_last
from .verbs import join_null_safe

RANKS = ("rank", "dense_rank", "percent_rank")


def global_rank(df: DataFrame, order: Sequence[str], names: Sequence[str] = RANKS) -> DataFrame:
    """Rank, dense rank and percent rank of every row in the order of the whole table; equal rows share theirs, unknown values come last.

    The table is range-partitioned; a partition ranks its own rows, and one summary row for each partition says how many rows and different values
    lie before it and where the value began that runs over its edge.
    """
    own = nulls_last(*order)
    rows = ordered_parts(df, order).withColumn("__value", own)
    inside = W.partitionBy(PART).orderBy("__value")
    rows = rows.withColumns({"__rank": F.rank().over(inside), "__dense": F.dense_rank().over(inside)})
    parts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.max("__dense").alias("values"), F.max("__rank").alias("last_rank"),
                                   F.min("__value").alias("first"), F.max("__value").alias("last"))
    # One row for each partition from here on.
    along = W.partitionBy(F.lit(0)).orderBy(PART)
    before = along.rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumns({"__before": F.coalesce(F.sum("n").over(before), F.lit(0)), "__goes_on": F.coalesce(F.lag("last").over(along) == F.col("first"), F.lit(False)),
                               "__all": F.sum("n").over(W.partitionBy(F.lit(0)))})
    began = F.when((F.col("values") > 1) | ~F.col("__goes_on"), F.col("__before") + F.col("last_rank"))
    parts = parts.withColumn("__began", began).select(
        PART, "__before", "__goes_on", "__all", F.last("__began", ignorenulls=True).over(before).alias("__start"),
        F.coalesce(F.sum(F.col("values") - F.col("__goes_on").cast("int")).over(before), F.lit(0)).alias("__values"))
    joined = rows.join(parts, PART)
    rank = F.when(F.col("__goes_on") & (F.col("__dense") == 1), F.col("__start")).otherwise(F.col("__before") + F.col("__rank"))
    dense = F.col("__values") + F.col("__dense") - F.col("__goes_on").cast("int")
    share = F.when(F.col("__all") > 1, (rank - 1) / (F.col("__all") - 1)).otherwise(0.0)
    return joined.select(*df.columns, *[c.alias(name) for c, name in zip((rank.cast("long"), dense.cast("long"), share), names)])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, name: str = "place") -> DataFrame:
    """The first ``k`` rows of every group (NULL is one too), numbered. ``order`` should tell all rows apart; what ties remain is cut anywhere.

    The engine keeps ``k`` rows of a group in each task before the shuffle, so a group of any size sends ``k`` rows a task.
    """
    by = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where(F.col(name) <= k)


def _digest(columns: Sequence[str]) -> list:
    """Two 64-bit hashes of a row, over the columns forwards and backwards. A hash skips unknown values, so which are unknown belongs to it."""
    unknown = [F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])]
    values = [F.col(c) for c in columns]
    return [F.xxhash64(*unknown, *values).alias("__digest"), F.xxhash64(*values[::-1], *unknown).alias("__other_digest")]


def differences(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows that occur in one table more often than in the other, with ``only_one`` and ``only_two``: how much more often.

    Columns go by name and must be the same; NULL equals NULL. Rows are counted by 128 bits of hashes, so 24 bytes of a row travel, and only rows whose
    hashes occur more often on one side are read again and compared whole.
    """
    if sorted(one.columns) != sorted(two.columns):
        raise ValueError(f"columns differ: {sorted(set(one.columns) ^ set(two.columns))}")
    columns = one.columns
    signed = one.withColumn("__n", F.lit(1)).unionByName(two.withColumn("__n", F.lit(-1))).select("*", *_digest(columns))
    keys = ["__digest", "__other_digest"]
    odd = stage(signed.groupBy(*keys).agg(F.sum("__n").alias("__n")).where("__n <> 0").select(*keys))
    net = signed.join(odd, keys, "left_semi").groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    return net.select(*columns, F.greatest("__n", F.lit(0)).cast("long").alias("only_one"), F.greatest(-F.col("__n"), F.lit(0)).cast("long").alias("only_two"))
