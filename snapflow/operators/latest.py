"""Latest row per key, and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.

    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle and
    a final one after it, so each map task ships at most one row per key: a
    hot key costs no more shuffle than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def top_k(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows by ``order`` (a feature of the report: the limit is the point).

    Planned as TakeOrderedAndProject: each task keeps its own best ``n``.
    """
    return df.orderBy(*order).limit(n)
