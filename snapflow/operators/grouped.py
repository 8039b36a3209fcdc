"""Grouped and global statistics built from partial-aggregatable pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.exprs import pct_of_total


def count_rows(alias: str) -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1)).alias(alias)


def total(col: str, alias: str) -> Column:
    """``SUM(col)``; NULL on an empty or all-NULL input."""
    return F.sum(col).alias(alias)


def count_where(predicate: Column, alias: str) -> Column:
    """``COUNT(*) FILTER (WHERE predicate)``; a NULL predicate is not counted."""
    return F.count_if(predicate).alias(alias)


def ratio_of_totals(num: str, den: str, alias: str, digits: int = 1) -> Column:
    """``ROUND(100.0 * SUM(num) / NULLIF(SUM(den), 0), digits)``."""
    return pct_of_total(F.sum(num), F.sum(den), digits).alias(alias)


def grouped_stats(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``GROUP BY by`` with the given aggregates, in order; a NULL group is kept.

    Every piece above (count, sum, count_if) has a partial form, so Spark
    combines map-side and only one row per group and task is shuffled: a
    group holding a third of the rows costs no more network than any other.
    """
    return df.groupBy(*by).agg(*aggs)


def global_stats(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """Aggregate without grouping: always exactly one row, even on empty input."""
    return df.agg(*aggs)
