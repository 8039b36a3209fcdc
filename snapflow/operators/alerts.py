"""Threshold alerts on per-key time series: time-to-zero and time-since-seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.exprs import minute_boundaries, round_half_away


def time_to_zero(
    latest: DataFrame,
    level_col: str,
    rate_col: str,
    horizon_minutes: float,
    out_col: str = "minutes_until_empty",
) -> DataFrame:
    """Rows whose level, falling at ``rate`` per minute, reaches zero within the horizon.

    Filter on the unrounded ETA (strict ``<``); report it rounded to whole
    minutes, so a value equal to the horizon can be shown.
    """
    level, rate = F.col(level_col), F.col(rate_col)
    eta = F.try_divide(level.cast("double"), F.abs(rate))
    shown = F.when(rate < 0, round_half_away(eta, 0))
    return latest.where((level > 0) & (rate < 0) & (eta < F.lit(float(horizon_minutes)))).withColumn(
        out_col, shown
    )


def time_since_last(
    rows: DataFrame,
    keys: Sequence[str],
    time_col: str,
    latest_by: Sequence[str],
    seen_when: Column,
    current_when: Column,
    threshold_minutes: int,
    *,
    output_cols: Sequence[str],
    seen_col: str = "last_seen",
    checked_col: str = "checked_at",
    minutes_col: str = "minutes_since",
) -> DataFrame:
    """Keys whose latest row satisfies ``current_when`` and whose last row
    satisfying ``seen_when`` lies more than ``threshold`` minute boundaries back.

    One pass: a conditional maximum of the time and the latest row (largest
    ``latest_by``, NULLs smallest) come out of the same partially combined
    aggregate, so the input is read once, shuffled once and never joined.
    """
    keys = list(keys)
    shown = [c for c in output_cols if c not in keys]
    order = F.struct(*[F.col(c) for c in latest_by], *[F.col(c) for c in shown], current_when.alias("__current"))
    latest = F.struct(*[F.col(c) for c in shown], F.col(time_col).alias("__t"), current_when.alias("__current"))
    per_key = rows.groupBy(*keys).agg(
        F.max(F.when(seen_when, F.col(time_col))).alias(seen_col), F.max_by(latest, order).alias("__latest")
    )
    minutes = minute_boundaries(F.col(seen_col), F.col("__latest.__t"))
    due = F.col("__latest.__current") & F.col(seen_col).isNotNull() & (minutes > F.lit(threshold_minutes))
    return per_key.where(due).select(
        *keys,
        *[F.col("__latest")[c].alias(c) for c in shown],
        F.col(seen_col),
        F.col("__latest.__t").alias(checked_col),
        minutes.alias(minutes_col),
    )
