"""Each station's newest snapshot of a day, kept with silver.

The reports of a day (at risk, district statistics, network summary, fastest
depletion) all start from the newest row per station.  The merge keeps that
row in a side table of silver, one per ``date`` partition, published in the
same manifest: it compares the rows it writes with the kept ones, so a tick
reads and writes one row per station, however long the day is, and late rows
find their place.  A rebuild leaves none; the first report on a day (or the next
merge into it) makes it from the day's silver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.config import PipelineConfig
from snapflow.operators.latest import latest_per_key
from snapflow.plans.gold import latest_order_of
from snapflow.schemas import LATEST, SOURCE_COLUMNS, STORED_SILVER
from snapflow.sources.lake import read_stored_silver
from snapflow.sources.sinks import remove, stage, staged_dates
from snapflow.sources.tables import PublishConflict, manifest, publish, read_side, side_of

STORED_COLUMNS = STORED_SILVER.fieldNames()
_WITHOUT_DATE = T.StructType([f for f in STORED_SILVER.fields if f.name != "date"])


def side_name(day: dt.date) -> str:
    return side_of(LATEST, day.isoformat())


def newest_of_days(rows: DataFrame) -> DataFrame:
    """The newest row of each (day, station) among stored silver rows."""
    dated = rows.where(F.col("date").isNotNull()).select(*STORED_COLUMNS)
    return latest_per_key(dated, ["date", "station_code"], latest_order_of(dated))


def kept_newest(spark: SparkSession, silver_path: str, day: dt.date) -> DataFrame | None:
    """The kept rows of a day; none if there are none."""
    kept = read_side(spark, silver_path, side_name(day), _WITHOUT_DATE)
    return None if kept is None else kept.withColumn("date", F.lit(day)).select(*STORED_COLUMNS)


def after_merge(
    spark: SparkSession, silver_path: str, days: Sequence[dt.date | None], replaced: DataFrame, written: DataFrame
) -> DataFrame:
    """The newest rows of ``days`` once ``written`` rows are in silver in place of the ``replaced`` (by source).

    A replaced row that was the newest of its station comes back among the
    written ones with other derived values, and these only decide between rows
    of equal times; so the kept rows and the written ones are all that can win.
    """
    stored = set(manifest(spark, silver_path)["parts"])
    known = []
    for day in days:
        if day is None or f"date={day.isoformat()}" not in stored:
            continue
        kept = kept_newest(spark, silver_path, day)
        if kept is None:  # a rebuild came before
            kept = read_stored_silver(spark, silver_path).where(F.col("date") == F.lit(day))
        known.append(kept)
    if not known:
        return newest_of_days(written)
    old = reduce(DataFrame.unionByName, known).join(replaced, SOURCE_COLUMNS, "left_anti")
    return newest_of_days(old.select(*STORED_COLUMNS).unionByName(written.select(*STORED_COLUMNS)))


def staged_newest(spark: SparkSession, cfg: PipelineConfig, newest: DataFrame) -> tuple[str, dict[str, str]]:
    """Stage the newest rows: the staging folder, and the folder of each day's side table in it."""
    folder = stage(newest, cfg.staging_path, partition_by="date", sort_by=["station_code"])
    days = staged_dates(spark, folder)
    return folder, {side_name(d): f"{folder}/date={d.isoformat()}" for d in days}


def keep_newest(spark: SparkSession, cfg: PipelineConfig, day: dt.date) -> None:
    """Make the kept rows of a day from its silver, if a rebuild has left none.

    If another writer publishes the day meanwhile, nothing is kept: a reader
    then works from the day's silver.
    """
    base = manifest(spark, cfg.silver_path)
    partition = f"date={day.isoformat()}"
    if partition not in base["parts"] or side_name(day) in base["parts"]:
        return
    rows = read_stored_silver(spark, cfg.silver_path).where(F.col("date") == F.lit(day))
    folder, sides = staged_newest(spark, cfg, newest_of_days(rows))
    try:
        publish(spark, None, cfg.silver_path, partitioned=True, side=sides, base=base, depends=[partition])
    except PublishConflict:
        pass
    finally:
        remove(spark, folder)


def read_newest(spark: SparkSession, cfg: PipelineConfig, day: dt.date) -> DataFrame:
    """Each station's newest row of a day: the kept ones, or else worked out from the day's silver."""
    kept = kept_newest(spark, cfg.silver_path, day)
    if kept is not None:
        return kept
    return newest_of_days(read_stored_silver(spark, cfg.silver_path).where(F.col("date") == F.lit(day)))


def read_all_newest(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The kept rows of all days that have them."""
    days = sorted(p.partition(".")[2] for p in manifest(spark, cfg.silver_path)["parts"] if p.startswith(side_of(LATEST, "")))
    kept = [kept_newest(spark, cfg.silver_path, dt.date.fromisoformat(d)) for d in days]
    return reduce(DataFrame.unionByName, kept) if kept else spark.createDataFrame([], STORED_SILVER)


__all__ = ["after_merge", "keep_newest", "kept_newest", "newest_of_days", "read_all_newest", "read_newest", "side_name", "staged_newest"]
