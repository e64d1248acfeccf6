"""Column-expression helpers: R-style NA rules, text and clock functions."""
from .rules import (  # noqa: F401
    ifelse_na, not_in, sum_na, whole_number, replace_first, extract_first, snake_case,
    sorted_names, split_names, opponent, type_act, clock_seconds, period_start_seconds, seconds_passed_game,
)
