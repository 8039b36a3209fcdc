from snapflow.functions.exprs import (
    duration_seconds,
    epoch_micros,
    guarded_pct,
    minute_boundaries,
    minute_index,
    ntz_literal,
    pct_of_total,
    python_datetime_text,
    round_half_away,
    round_half_even,
    yes_flag,
)

__all__ = [
    "duration_seconds",
    "epoch_micros",
    "guarded_pct",
    "minute_boundaries",
    "minute_index",
    "ntz_literal",
    "pct_of_total",
    "python_datetime_text",
    "round_half_away",
    "round_half_even",
    "yes_flag",
]
