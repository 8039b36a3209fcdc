"""Per-key LAG that stays balanced when one key holds a large share of rows.

``LAG(x) OVER (PARTITION BY key ORDER BY t, tiebreak...)`` needs every row of
a key in one task.  With a hot key (say a third of all rows) that task is a
straggler as large as the data.  ``with_lag`` therefore:

1. finds the keys with more than ``rows_per_slice`` rows: from ``hot``, a
   statistic the caller has kept (see ``heavy_keys``), or else by counting rows
   per key (partial aggregation, only the key columns are read);
2. if there is none it plans the plain window;
3. otherwise the rows of the hot keys, and only those, are range partitioned
   by (key, order, tie-break) and written to the shared scratch folder.  The
   range bounds are quantiles of the rows themselves, so an outlier time, many
   NULL times or one repeated time still give even ranges.  There are never
   more ranges than shuffle partitions: a range holds as many slices of
   ``rows_per_slice`` rows as fall to it, and the window runs over all of them
   in its task (it spills, so its memory is bounded).  Only the first row of a
   key in a range takes its value from another task: the last row of the key's
   previous range, found by a (key, range) aggregate of one row each.

The order always ends with a hash of the whole row, in both forms, so rows
that tie on every order column are ordered the same way in both and the
results are equal.  NULL keys are one group, NULL order values sort last.

The hot-key table holds at most ``total_rows / rows_per_slice`` rows; it is
broadcast only when its counted size is under ``broadcast_max_rows``,
otherwise it is joined by shuffle (AQE splits the skewed side).  A statistic
that misses a key or names one too many changes the plan, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.functions.exprs import minute_boundaries, round_half_away
from snapflow.session import scratch_path

TIE = "__tie"


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int) -> DataFrame:
    """``__k`` (struct of the key) and ``__n`` of keys with more than ``rows_per_slice`` rows."""
    counts = df.select(_key(keys).alias("__k")).groupBy("__k").agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > F.lit(rows_per_slice))


def ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, rows_per_slice: int) -> DataFrame:
    """``df``, of ``rows`` rows, with its range number ``__s``: even ranges of (key, order), written."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc_nulls_last() for k in keys] + _ascending(order)
    spread = df.repartitionByRange(max(1, min(most, math.ceil(rows / rows_per_slice))), *by)
    return _written(spread.withColumn("__s", F.spark_partition_id()), "lag-ranges")


HEAVY_ITEMS = 4096  # of one sketch


def key_sketches(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``by`` columns and ``sketch``: a mergeable heavy-hitter sketch of ``key`` for each group."""
    sketch = F.call_function("approx_top_k_accumulate", F.col(key), F.lit(HEAVY_ITEMS))
    return df.groupBy(*by).agg(sketch.alias("sketch"))


def heavy_keys(sketches: DataFrame, key: str) -> DataFrame:
    """``key`` and ``__n``: the heaviest keys of all sketches merged, with their estimated rows.

    A key is missed only if it holds less than about 1 / ``HEAVY_ITEMS`` of all rows.
    """
    merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(HEAVY_ITEMS))
    # Grouped by a constant, as the function cannot merge the nothing of a partition without rows.
    top = sketches.groupBy(F.lit("all")).agg(F.call_function("approx_top_k_estimate", merged, F.lit(HEAVY_ITEMS)).alias("top"))
    return top.select(F.inline("top")).select(F.col("item").alias(key), F.col("count").alias("__n"))


def with_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    *,
    prefix: str = "prev_",
    rows_per_slice: int | None = None,
    broadcast_max_rows: int = 1_000_000,
    tie_cols: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Append ``prefix + c`` = LAG(c) per key, ordered ascending (NULLS LAST) by ``order``.

    ``tie_cols`` (default: all columns) are hashed for the tie-break; rows equal
    in all of them are interchangeable.  ``hot`` (key columns and ``__n``) is a
    kept statistic of heavy keys; without it rows are counted per key.
    """
    keys, order, columns = list(keys), [*order, TIE], list(columns)
    tied = df.withColumn(TIE, F.xxhash64(*([F.col(f"`{c}`") for c in tie_cols] if tie_cols else _quoted(df))))
    return _with_lag(tied, df, keys, order, columns, prefix, rows_per_slice, broadcast_max_rows, hot).drop(TIE)


def _with_lag(
    tied: DataFrame,
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    prefix: str,
    rows_per_slice: int | None,
    broadcast_max_rows: int,
    known: DataFrame | None,
) -> DataFrame:
    """``with_lag`` on rows that carry their tie-break."""
    shown = [*_quoted(df), F.col(TIE)]

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_ascending(order))
        return rows.select(*shown, *[F.lag(c).over(w).alias(prefix + c) for c in columns])

    if rows_per_slice is None:
        return plain(tied)
    if known is None:
        hot = hot_keys(df, keys, rows_per_slice)
    else:
        hot = known.where(F.col("__n") > F.lit(rows_per_slice)).select(_key(keys).alias("__k"), "__n")
    hot = _written(hot, "hot-keys")
    n_hot, rows = hot.agg(F.count(F.lit(1)), F.sum("__n")).first()
    if n_hot == 0:
        return plain(tied)
    side = hot.select("__k")
    side = F.broadcast(side) if n_hot <= broadcast_max_rows else side
    keyed = tied.withColumn("__k", _key(keys))
    parts = ranges(keyed.join(side, "__k", "left_semi"), keys, order, rows, rows_per_slice)

    w = Window.partitionBy("__k", "__s").orderBy(*_ascending(order))
    windowed = parts.select(
        "*", F.row_number().over(w).alias("__rn"), *[F.lag(c).over(w).alias("__l_" + c) for c in columns]
    )
    # Last row of every range: max over (is-null, value) pairs = last under ASC NULLS LAST.
    fields: list[Column] = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"__o{i}n"), F.col(c).alias(f"__o{i}")]
    last = parts.groupBy("__k", "__s").agg(
        F.max(F.struct(*fields, *[F.col(c).alias("__v_" + c) for c in columns])).alias("__last")
    )
    per_key = Window.partitionBy("__k").orderBy("__s")
    carry = last.select(
        "__k", "__s", *[F.lag(F.col("__last")["__v_" + c]).over(per_key).alias("__c_" + c) for c in columns]
    )
    hot_rows = windowed.join(carry, ["__k", "__s"], "left").select(
        *shown,
        *[
            F.when(F.col("__rn") > 1, F.col("__l_" + c)).otherwise(F.col("__c_" + c)).alias(prefix + c)
            for c in columns
        ],
    )
    return plain(keyed.join(side, "__k", "left_anti")).union(hot_rows)


def with_delta_rate(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    tiebreak: Sequence[str],
    value_col: str,
    *,
    prev_col: str,
    delta_col: str,
    minutes_col: str,
    rate_col: str,
    rate_digits: int = 4,
    rows_per_slice: int | None = None,
    broadcast_max_rows: int = 1_000_000,
    tie_cols: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Previous value, change, minute boundaries crossed, and change per minute.

    rate = ROUND(delta / minutes, n) when minutes > 0, else NULL.
    """
    lagged = with_lag(
        df,
        keys,
        [time_col, *tiebreak],
        [value_col, time_col],
        prefix="__p_",
        rows_per_slice=rows_per_slice,
        broadcast_max_rows=broadcast_max_rows,
        tie_cols=tie_cols,
        hot=hot,
    )
    delta = F.col(value_col) - F.col("__p_" + value_col)
    minutes = minute_boundaries(F.col("__p_" + time_col), F.col(time_col))
    rate = F.when(minutes > 0, round_half_away(delta.cast("double") / minutes, rate_digits))
    return lagged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("__p_" + value_col).alias(prev_col),
        delta.alias(delta_col),
        minutes.alias(minutes_col),
        rate.alias(rate_col),
    )
