"""Insight queries served from silver and gold (one DataFrame each, no dict shaping)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.config import TOP_AT_RISK, TOP_DEPLETION, TOP_EMPTY
from snapflow.functions.exprs import guarded_pct, python_datetime_text, round_half_away
from snapflow.operators.grouped import count_rows, count_where, global_stats, total
from snapflow.operators.latest import top_k
from snapflow.plans.gold import as_date, day, latest_of_day


def snapshots_from_listing(listing: DataFrame, as_of) -> DataFrame:
    """Number of bronze files under ``date=<as_of>/`` (one file per snapshot)."""
    date_text = F.date_format(as_date(as_of), "yyyy-MM-dd")
    in_day = F.col("path").contains(F.concat(F.lit("date="), date_text, F.lit("/")))
    return listing.where(in_day & F.col("path").endswith(".parquet")).agg(
        F.count(F.lit(1)).alias("bronze_snapshots_today")
    )


def snapshots_from_rows(bronze: DataFrame, as_of) -> DataFrame:
    """Snapshot count from the data itself: distinct ingest stamps of the day.

    Exact even when one append wrote several files.
    """
    return day(bronze, as_of).agg(F.count_distinct("ingested_at").alias("bronze_snapshots_today"))


def snapshot_metrics(snapshots: DataFrame, silver: DataFrame, as_of=None) -> DataFrame:
    """One row: date, bronze_snapshots_today, stations_per_snapshot.

    ``stations_per_snapshot`` counts distinct stations in the day's newest
    ingest; the newest stamp is an uncorrelated scalar subquery.
    """
    today = day(silver, as_of)
    newest = today.agg(F.max("ingested_at")).scalar()
    stations = today.where(F.col("ingested_at") == newest).agg(
        F.count_distinct("station_code").alias("stations_per_snapshot")
    )
    return stations.select(
        F.date_format(as_date(as_of), "yyyy-MM-dd").alias("date"),
        snapshots.scalar().cast("long").alias("bronze_snapshots_today"),
        F.col("stations_per_snapshot"),
    )


def network_summary(silver: DataFrame, as_of=None) -> DataFrame:
    """Global totals over each station's latest snapshot of the day (always one row)."""
    return network_summary_of(latest_of_day(silver, as_of))


def network_summary_of(latest: DataFrame) -> DataFrame:
    """The same from the newest row per station."""
    totals = global_stats(
        latest,
        [
            count_rows("total_stations"),
            count_where(~F.col("is_renting") | ~F.col("is_returning"), "inactive_stations"),
            count_where((F.col("bikes_available") == 0) & F.col("is_renting"), "empty_stations"),
            total("bikes_available", "total_bikes"),
            total("bikes_mechanical", "total_mechanical"),
            total("bikes_electric", "total_electric"),
            total("docks_available", "total_docks_available"),
        ],
    )
    return totals.select(
        "total_stations",
        (F.col("total_stations") - F.col("inactive_stations")).alias("active_stations"),
        "inactive_stations",
        "empty_stations",
        "total_bikes",
        "total_mechanical",
        "total_electric",
        "total_docks_available",
        guarded_pct("total_electric", "total_bikes", 1).alias("pct_electric"),
    )


def _position(with_rank: bool) -> list[str]:
    return ["rank", "result_count"] if with_rank else []


def top_at_risk(at_risk: DataFrame, n: int = TOP_AT_RISK, with_rank: bool = False) -> DataFrame:
    """The ``n`` stations closest to running empty; ``with_rank`` adds position and number of results."""
    best = ranked(at_risk, n, [F.col("minutes_until_empty").asc_nulls_last(), F.col("station_code")])
    return best.select(
        *_position(with_rank),
        "station_name",
        "bikes_available",
        round_half_away("depletion_rate_per_minute", 4).alias("depletion_rate_per_minute"),
        "minutes_until_empty",
        "arrondissement",
    )


def top_depletion(silver: DataFrame, as_of=None, n: int = TOP_DEPLETION, with_rank: bool = False) -> DataFrame:
    """The ``n`` fastest-emptying stations (latest snapshot, rate < 0; bikes may be 0)."""
    return top_depletion_of(latest_of_day(silver, as_of), n, with_rank)


def top_depletion_of(latest: DataFrame, n: int = TOP_DEPLETION, with_rank: bool = False) -> DataFrame:
    """The same from the newest row per station."""
    emptying = latest.where(F.col("depletion_rate_per_minute") < 0)
    best = ranked(emptying, n, [F.col("depletion_rate_per_minute").asc_nulls_last(), F.col("station_code")])
    return best.select(
        *_position(with_rank),
        "station_name",
        "bikes_available",
        round_half_away("depletion_rate_per_minute", 4).alias("depletion_rate_per_minute"),
        "arrondissement",
    )


def top_empty(empty: DataFrame, n: int = TOP_EMPTY, with_rank: bool = False) -> DataFrame:
    """The ``n`` stations empty for longest; the timestamp rendered as text."""
    best = ranked(empty, n, [F.col("minutes_empty").desc_nulls_last(), F.col("station_code")])
    return best.select(
        *_position(with_rank),
        "station_name",
        "arrondissement",
        "minutes_empty",
        python_datetime_text("last_seen_with_bikes").alias("last_seen_with_bikes"),
    )


def ordered_districts(stats: DataFrame) -> DataFrame:
    """District statistics with their reading position (``rank``), NULL district last.

    One row per district, so the ordering window is small.
    """
    order = Window.orderBy(F.col("arrondissement").asc_nulls_last())
    return stats.select(F.row_number().over(order).alias("rank"), *stats.columns)


def ranked(rows: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows with their position (``rank``) and the number of rows shown (``result_count``).

    The limit comes first (each task keeps its own best ``n``), so the windows
    see at most ``n`` rows.
    """
    best = top_k(rows, n, order)
    return best.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        *best.columns,
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("result_count"),
    )
