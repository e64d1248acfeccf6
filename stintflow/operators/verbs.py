"""Relational verbs with the duplicate, NULL and order rules of the data model."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import snake_case


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every column name; a repeated result gets a numeric suffix."""
    seen: dict[str, int] = {}
    names = []
    for column in df.columns:
        name = snake_case(column)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def select_any(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Project and rename (new -> old); columns the frame lacks are skipped."""
    return df.select(*[F.col(old).alias(new) for new, old in wanted.items() if old in df.columns])


def columns_where(df: DataFrame, *, prefix: str = "", contains: str = "") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and contains in c]


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    return df.columns[df.columns.index(first):df.columns.index(last) + 1]


def columns_first(df: DataFrame, *first: str) -> DataFrame:
    """Move columns to the front, keep the rest in place."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def across(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column], names: str = "{col}") -> DataFrame:
    """Apply one expression to several columns, optionally under new names."""
    return df.withColumns({names.format(col=c): fn(F.col(c)) for c in columns})


def prefix_columns(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def lookup_table(df: DataFrame, key: str, value: str, *, new_key: str, new_value: str) -> DataFrame:
    """One row per key, so that joining it never multiplies rows; the smallest value wins over a conflicting one."""
    return (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(new_key))
            .agg(F.min(value).alias(new_value)))


def rows_update(df: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite matched rows with the values of ``changes`` (also with NULL); unmatched rows stay as they are. A NULL key matches a NULL key.

    A key that occurs twice in ``changes`` has no defined result and fails the query.
    """
    updated = [c for c in changes.columns if c not in keys]
    unique = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(f"__{c}") for c in updated])
    checked = unique.withColumn(
        "__hit", F.when(F.col("__n") > 1, F.raise_error(F.lit("rows_update: duplicate key")).cast("boolean")).otherwise(True))
    joined = join_null_safe(df, checked.drop("__n"), list(keys), "left")
    return joined.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in updated}).select(
        *df.columns)


def nulls_last(*order: str) -> Column:
    """Position to compare rows by, in which an unknown value comes after all others."""
    return F.struct(*[column for o in order for column in (F.col(o).isNull().alias(f"{o}_unknown"), F.col(o).alias(o))])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in an explicit order (unknown values last), as an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), nulls_last(*order))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key; a row with an unknown value in the order comes after those without."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), nulls_last(*order))
    return df.groupBy(*keys).agg(row.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def pivot_first(df: DataFrame, keys: Sequence[str], names_from: str, values: Sequence[str], levels: Sequence[str],
                order: Sequence[str], names: str = "{value}_{level}") -> DataFrame:
    """Long to wide over known levels; among several rows for a cell the first in ``order`` (unknown values last) wins."""
    cells = [F.min_by(value, F.when(F.col(names_from) == level, nulls_last(*order))).alias(
        names.format(value=value, level=level)) for value in values for level in levels]
    return df.groupBy(*keys).agg(*cells)


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str,
                    prefix: str = "") -> DataFrame:
    """Wide to long, keeping NULL values; ``prefix`` is cut from the names that have it."""
    named = {c: c.removeprefix(prefix) for c in columns}
    return df.select(*ids, *[F.col(c).alias(new) for c, new in named.items()]).unpivot(list(ids), list(named.values()), name, value)


def join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match NULL keys; the keys of ``df`` stay."""
    renamed = other.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return df.join(renamed, same, how).drop(*[f"__of_{k}" for k in keys])


def fallback_join(df: DataFrame, other: DataFrame, fine: Sequence[str], coarse: Sequence[str], value: str) -> DataFrame:
    """Look up ``value`` by the fine key, and by the coarse key only where the fine key found nothing.

    The looked-up side is reduced to its smallest value per key first, so neither join multiplies rows.
    """
    exact = other.groupBy(*fine).agg(F.min(value).alias(value))
    rough = other.groupBy(*coarse).agg(F.min(value).alias("__rough")).withColumn("__open", F.lit(True))
    found = join_null_safe(df, exact, fine, "left").withColumn("__open", F.col(value).isNull())
    return (join_null_safe(found, rough, [*coarse, "__open"], "left")
            .withColumn(value, F.coalesce(F.col(value), F.col("__rough"))).drop("__open", "__rough"))


def group_filter(df: DataFrame, keys: Sequence[str], having: Column) -> DataFrame:
    """Keep the rows of groups (NULL is one too) that pass a test on aggregates.

    The test is pre-aggregated and joined, not a window, so a group with a large share of the rows never meets in one task.
    """
    passed = df.groupBy(*keys).agg(having.alias("__pass")).where("__pass").select(*keys)
    return join_null_safe(df, passed, keys, "left_semi")


def attach_aggregates(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Aggregates of every group (NULL is one too) as columns of its rows, joined for the same reason as in ``group_filter``."""
    return join_null_safe(df, df.groupBy(*keys).agg(*[column.alias(name) for name, column in aggregates.items()]), keys, "left")
