"""Aggregates over many groupings at once, sessions by gaps, and sketches that merge."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Relative standard error of the distinct sketch is about 1.04 / 2**(LG_K / 2); a KLL sketch of this k errs by at most 1.33 % of the rows (99 %).
LG_K, KLL_K = 14, 200
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (LG_K / 2), 0.0266


def cube(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column], *, rollup: bool = False) -> DataFrame:
    """Aggregates for every subset of the keys (or, as a roll-up, every leading part of them) in one pass.

    ``is_total_<key>`` tells the NULL of a total from a NULL key.
    """
    grouped = df.rollup(*keys) if rollup else df.cube(*keys)
    marks = [F.grouping(k).cast("boolean").alias(f"is_total_{k}") for k in keys]
    return grouped.agg(*marks, *[column.alias(name) for name, column in aggregates.items()])


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap: str, aggregates: dict[str, Column]) -> DataFrame:
    """One row per session: rows of a group that follow each other by at most ``gap``, with ``session_start`` and ``session_end`` (its last row).

    Works on tables and on streams (there with a watermark on ``time``). Rows without a time belong to no session.
    """
    window = F.session_window(time, gap)
    found = df.where(F.col(time).isNotNull()).groupBy(*keys, window.alias("__session")).agg(
        F.max(time).alias("session_end"), *[column.alias(name) for name, column in aggregates.items()])
    return found.select(*keys, F.col("__session.start").alias("session_start"), "session_end", *aggregates)


def sketched(df: DataFrame, keys: Sequence[str], member: str, value: str) -> DataFrame:
    """One row per group with a sketch of its distinct members and one of the distribution of its values, to be stored and merged later."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(member, F.lit(LG_K)).alias("members"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("values"))


def merged(sketches: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Estimates of coarser groups from stored sketches; the rows themselves are not read again."""
    both = sketches.groupBy(*keys).agg(F.hll_union_agg("members").alias("members"), F.kll_merge_agg_double("values").alias("values"))
    return both.select(*keys, F.hll_sketch_estimate("members").alias("n_members"), F.kll_sketch_get_n_double("values").alias("n_values"),
                       *[F.kll_sketch_get_quantile_double("values", F.lit(q)).alias(f"q{round(100 * q)}") for q in quantiles])
