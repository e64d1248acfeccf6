"""

Everything here returns a ``Column`` built from JVM-side functions, so it stays inside whole-stage code generation.
"""
from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

NAME_SEPARATOR = ", "


def ifelse_na(condition: Column, yes, no) -> Column:
    """Two-way choice that is NULL where the condition is NULL (a plain ``otherwise`` would take ``no``)."""
    return F.when(condition, yes).when(~condition, no)


def not_in(column: Column, values: Iterable) -> Column:
    """Negated membership that keeps rows whose value is NULL."""
    return ~F.coalesce(column.isin(list(values)), F.lit(False))


def sum_na(column: Column) -> Column:
    """Aggregate sum that is NULL as soon as one input is NULL."""
    return F.when(F.count(F.lit(1)) == F.count(column), F.sum(column))


def whole_number(column: Column) -> Column:
    """Integer of a number or of its text, decimals cut off (``10.7`` -> 10, ``401.0`` -> 401); NULL if there is none or it is out of range."""
    number = column.try_cast("double")
    return F.when(F.abs(number) < 2147483648, number.cast("int"))


def replace_first(column: Column, word: str, replacement: str) -> Column:
    """Replace the first occurrence of a literal word; later occurrences stay."""
    return F.regexp_replace(column, f"^((?s:.*?)){re.escape(word)}", f"$1{replacement}")


def extract_first(column: Column, pattern: str) -> Column:
    """First match of ``pattern``, NULL (not an empty string) when there is none."""
    return F.nullif(F.regexp_extract(column, pattern, 0), F.lit(""))


def snake_case(name: str) -> str:
    """Column name in snake case: ``locX`` -> ``loc_x``, ``Total Price ($)`` -> ``total_price``; digits stay joined (``FG3M`` -> ``fg3m``)."""
    spaced = re.sub(r"([a-z])([A-Z])", r"\1_\2", name.replace("%", " percent ").replace("#", " number "))
    spaced = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", spaced)
    cleaned = re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()
    return f"x{cleaned}" if cleaned[:1].isdigit() else cleaned or "x"


def sorted_names(column: Column) -> Column:
    """Array of names as one sorted, comma separated string; NULL stays NULL."""
    return F.array_join(F.array_sort(column), NAME_SEPARATOR)


def split_names(column: Column) -> Column:
    return F.split(column, NAME_SEPARATOR)


def opponent(team: Column, home: Column | str = "team_home", away: Column | str = "team_away") -> Column:
    """The other team of the game; NULL when the team is unknown."""
    home = F.col(home) if isinstance(home, str) else home
    away = F.col(away) if isinstance(away, str) else away
    return ifelse_na(team == home, away, home)


def type_act(msg_type: int, acts: int | Iterable[int]) -> Column:
    """Test on the pair (msg_type, act_type)."""
    acts = [acts] if isinstance(acts, int) else list(acts)
    return (F.col("msg_type") == msg_type) & F.col("act_type").isin(acts)


def clock_seconds(clock: Column) -> Column:
    """Seconds left in the period from ``MM:SS`` or ``MM:SS.s``; missing pieces give NULL."""
    parts = F.split(clock, ":")
    return F.get(parts, 0).try_cast("int") * 60 + F.get(parts, 1).try_cast("double")


# Fixed values of the game clock: four periods of 600 s, then overtimes of 300 s from second 2400 on.
PERIOD_SECONDS, OVERTIME_SECONDS, REGULAR_PERIODS = 600, 300, 4


def period_start_seconds(period: Column) -> Column:
    overtime_start = PERIOD_SECONDS * REGULAR_PERIODS
    return F.when(period <= REGULAR_PERIODS, (period - 1) * PERIOD_SECONDS).otherwise(
        overtime_start + (period - REGULAR_PERIODS - 1) * OVERTIME_SECONDS)


def seconds_passed_game(period: Column, clock: Column) -> Column:
    length = F.when(period <= REGULAR_PERIODS, PERIOD_SECONDS).otherwise(OVERTIME_SECONDS)
    return period_start_seconds(period) + (length - clock_seconds(clock))
