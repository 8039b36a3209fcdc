"""The sixteen data tests on silver, and the gate in front of gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.config import DELTA_RANGE, RATE_RANGE
from snapflow.operators.quality import Check, assert_passed, run_checks, violations

SHOW = ("station_code", "station_name", "last_reported")

SILVER_CHECKS: tuple[Check, ...] = (
    Check("not_null__station_code", "not_null", "station_code"),
    Check("not_null__station_name", "not_null", "station_name"),
    Check("not_null__bikes_available", "not_null", "bikes_available"),
    Check("range__bikes_available", "accepted_range", "bikes_available", min_value=0),
    Check("not_null__capacity", "not_null", "capacity"),
    Check("range__capacity", "accepted_range", "capacity", severity="warn", min_value=1),
    Check("not_null__last_reported", "not_null", "last_reported"),
    Check("not_null__is_renting", "not_null", "is_renting"),
    Check("values__is_renting", "accepted_values", "is_renting", values=(True, False)),
    Check("not_null__is_returning", "not_null", "is_returning"),
    Check("values__is_returning", "accepted_values", "is_returning", values=(True, False)),
    Check(
        "range__depletion_rate_per_minute",
        "accepted_range",
        "depletion_rate_per_minute",
        severity="warn",
        min_value=RATE_RANGE[0],
        max_value=RATE_RANGE[1],
    ),
    Check("range__bikes_delta", "accepted_range", "bikes_delta", severity="warn", min_value=DELTA_RANGE[0], max_value=DELTA_RANGE[1]),
    Check("bikes_not_negative", "expression", predicate=lambda: F.col("bikes_available") < 0),
    Check("capacity_positive", "expression", predicate=lambda: F.col("capacity") <= 0),
    Check(
        "rate_within_capacity",
        "expression",
        # A station cannot gain or lose more than it holds in a minute; NULL rates pass.
        predicate=lambda: F.abs("depletion_rate_per_minute") > F.col("capacity"),
    ),
)


def silver_quality_report(silver: DataFrame) -> DataFrame:
    """One row per check with its failure count and status (one scan of silver)."""
    return run_checks(silver, SILVER_CHECKS)


def silver_violations(silver: DataFrame) -> DataFrame:
    """Every failing row of the row-level checks, tagged with the check."""
    return violations(silver, SILVER_CHECKS, SHOW)


def gate_silver(silver: DataFrame) -> list[dict]:
    """Raise ``QualityGateError`` when an error-severity check fails."""
    return assert_passed(silver_quality_report(silver))


def log_silver(silver: DataFrame) -> list[dict]:
    """Run the same checks; a failing one is only logged."""
    return assert_passed(silver_quality_report(silver), stop=False)
