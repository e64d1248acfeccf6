"""A whole table in one order, as written range partitions: the ground for scans and ranks whose groups may be of any size.

Rows get a written number first, so equal rows spread over partitions as well, and the same rows come back when an executor is lost.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.shared import stage

PART, AT = "__part", "__at"


def ascending(*columns: str) -> list[Column]:
    """Order in which unknown values come last."""
    return [F.col(c).asc_nulls_last() for c in columns]


def ordered_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, written in ``order`` over range partitions, with ``PART`` (number of the partition) and ``AT`` (rises along the whole order)."""
    rows = stage(df.withColumn("__row", F.monotonically_increasing_id()))
    by = [*ascending(*order), F.col("__row")]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    return stage(ordered.withColumn(PART, F.shiftright(AT, 33)).drop("__row"))
