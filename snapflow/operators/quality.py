"""Declarative data tests evaluated in one aggregate pass, plus a publish gate."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityGateError(RuntimeError):
    """Raised when an error-severity check has failures; downstream must not run."""


@dataclass(frozen=True)
class Check:
    """One data test.

    kind:
      ``not_null``        failures = rows where column IS NULL
      ``accepted_range``  failures = rows where NOT (min <= column <= max); NULL passes
      ``accepted_values`` failures = distinct column values not in ``values``; NULL passes
      ``expression``      failures = rows where ``predicate`` (SQL text, or a function giving a column) is true
    """

    name: str
    kind: str
    column: str | None = None
    severity: str = "error"
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = ()
    predicate: str | Callable[[], Column] | None = None
    show: tuple[str, ...] = field(default_factory=tuple)

    def failing(self) -> Column:
        """Predicate true on a failing row (NULL counts as not failing)."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_range":
            c = F.col(self.column)
            ok = F.lit(True)
            if self.min_value is not None:
                ok = ok & (c >= F.lit(self.min_value))
            if self.max_value is not None:
                ok = ok & (c <= F.lit(self.max_value))
            return ~ok
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.values)
        if self.kind == "expression":
            return self.predicate() if callable(self.predicate) else F.expr(self.predicate)
        raise ValueError(f"unknown check kind {self.kind!r}")

    def failures(self) -> Column:
        if self.kind == "accepted_values":
            return F.count_distinct(F.when(self.failing(), F.col(self.column)))
        return F.count_if(self.failing())


def _failures(check: Check, df: DataFrame) -> Column:
    """The failure count of ``check`` on ``df``.

    An ``accepted_values`` test that accepts both true and false cannot fail
    on a BOOLEAN column (NULL passes), so it needs no distinct count: this
    keeps the whole report a single partial-aggregate pass.
    """
    if (
        check.kind == "accepted_values"
        and isinstance(df.schema[check.column].dataType, T.BooleanType)
        and {True, False} <= set(check.values)
    ):
        return F.lit(0)
    return check.failures()


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in one scan; one output row per check, in declaration order.

    Columns: check_order, check_name, column_name, severity, failures, status
    (``pass`` / ``warn`` / ``fail``).
    """
    counts = df.agg(*[_failures(c, df).cast("long").alias(f"__c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("check_order"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"__c{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        ]
    )
    report = counts.select(F.inline(rows))
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return report.withColumn("status", status)


def violations(df: DataFrame, checks: Sequence[Check], key_cols: Sequence[str]) -> DataFrame:
    """Failing rows of every check: check_name, severity, key columns.

    An ``accepted_values`` check counts distinct bad values in the report; here
    every row that holds one is shown.

    One pass over ``df``: each row carries the array of checks it fails,
    which is exploded (a row failing two checks appears twice).
    """
    tags = F.array(
        *[
            F.when(c.failing(), F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity")))
            for c in checks
        ]
    )
    failing = F.filter(tags, lambda t: t.isNotNull())
    return (
        df.select(F.explode(failing).alias("__v"), *key_cols)
        .select(F.col("__v.check_name").alias("check_name"), F.col("__v.severity").alias("severity"), *key_cols)
    )


def assert_passed(report: DataFrame, stop: bool = True) -> list[dict]:
    """Raise ``QualityGateError`` if any error-severity check failed; without ``stop`` only say so in the log.

    Collects the report only (one row per check), never the data.
    """
    rows = [r.asDict() for r in report.orderBy("check_order").collect()]
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        names = ", ".join(f"{r['check_name']}={r['failures']}" for r in failed)
        if stop:
            raise QualityGateError(f"data tests failed: {names}")
        logging.getLogger(__name__).warning("data tests failed: %s", names)
    return rows
