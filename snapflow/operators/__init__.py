from snapflow.operators.alerts import time_since_last, time_to_zero
from snapflow.operators.flatten import flatten_structs, normalize_pair
from snapflow.operators.grouped import (
    count_rows,
    count_where,
    global_stats,
    grouped_stats,
    ratio_of_totals,
    total,
)
from snapflow.operators.lag import hot_keys, with_delta_rate, with_lag
from snapflow.operators.latest import latest_per_key, top_k
from snapflow.operators.quality import Check, QualityGateError, assert_passed, run_checks, violations

__all__ = [
    "Check",
    "QualityGateError",
    "assert_passed",
    "count_rows",
    "count_where",
    "flatten_structs",
    "global_stats",
    "grouped_stats",
    "hot_keys",
    "latest_per_key",
    "normalize_pair",
    "ratio_of_totals",
    "run_checks",
    "time_since_last",
    "time_to_zero",
    "top_k",
    "total",
    "violations",
    "with_delta_rate",
    "with_lag",
]
