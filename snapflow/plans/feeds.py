"""Views of the shared test tables in the shapes the pipeline consumes.

``events`` is read as a snapshot feed: a user is a station, the event time
is the station's report time, and the feed is polled every 10 minutes (the
poll after the event stamps ``ingested_at`` and its ``date`` partition).
The rest of the bronze columns are derived from the event row, so every
pipeline stage runs on data whose size grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


POLL_MINUTES = 10


def _text(c) -> F.Column:
    return c.cast("string")


def events_as_bronze(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> bronze rows."""
    uid = F.col("user_id")
    bikes = F.floor(F.col("value") / F.lit(4)).cast("long")
    mechanical = F.expr("(CAST(FLOOR(value / 4) AS BIGINT) * 3) div 5")
    capacity = F.greatest(bikes, F.lit(60).cast("long"))
    flag = lambda bad: F.when(F.col("event_type") == bad, F.lit("NON")).otherwise(F.lit("OUI"))
    ts = F.col("ts")
    poll = (
        ts.cast("date").cast("timestamp_ntz")
        + F.make_dt_interval(
            F.lit(0),
            F.hour(ts),
            F.expr(f"(minute(ts) div {POLL_MINUTES}) * {POLL_MINUTES} + {POLL_MINUTES}"),
            F.lit(0),
        )
    )
    out = events.select(
        _text(uid).alias("stationcode"),
        F.concat(F.lit("station "), _text(uid)).alias("name"),
        F.when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("district-"), _text(F.expr("user_id div 10"))))
        .alias("nom_arrondissement_communes"),
        F.concat(F.lit("75"), _text(F.expr("user_id div 100"))).alias("code_insee_commune"),
        bikes.alias("numbikesavailable"),
        mechanical.alias("mechanical"),
        (bikes - mechanical).alias("ebike"),
        (capacity - bikes).alias("numdocksavailable"),
        capacity.alias("capacity"),
        flag("error").alias("is_installed"),
        flag("signup").alias("is_renting"),
        flag("view").alias("is_returning"),
        (uid.cast("double") / F.lit(1000)).alias("coordonnees_geo.lat"),
        (F.col("event_id").cast("double") / F.lit(1000)).alias("coordonnees_geo.lon"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("duedate"),
        poll.alias("ingested_at"),
        poll.cast("date").alias("date"),
    )
    return out  # column names, order and types are those of BRONZE (checked in tests)


REPEAT_EVERY = 40


def with_repeats(events: DataFrame) -> DataFrame:
    """The feed as a careless poller delivers it: every 40th record stands twice in its poll."""
    return events.union(events.where(F.col("event_id") % REPEAT_EVERY == 0))


def bronze_file_listing(bronze: DataFrame, prefix: str = "bronze") -> DataFrame:
    """The files a one-file-per-poll writer would have produced for ``bronze``:
    ``<prefix>/date=YYYY-MM-DD/HH-mm-ss.parquet`` stamped with the poll time."""
    path = F.concat(
        F.lit(prefix + "/date="),
        F.date_format(F.col("date"), "yyyy-MM-dd"),
        F.lit("/"),
        F.date_format(F.col("ingested_at"), "HH-mm-ss"),
        F.lit(".parquet"),
    )
    return bronze.select(path.alias("path"), F.col("ingested_at").alias("modificationTime")).distinct()


def conversations_as_runs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conversations(conv_id, turn, role, text) -> (runs, steps) of a run log.

    One conversation is one run, one turn one step keyed ``<role>_1``.
    Returned flat (runs, steps) so no group is ever collected.
    """
    start = F.col("conv_id").cast("double") * F.lit(3600.0)
    steps = conversations.select(
        F.concat(F.lit("run-"), _text(F.col("conv_id"))).alias("run_id"),
        F.col("turn").alias("position"),
        F.concat(F.col("role"), F.lit("_1")).alias("step_key"),
        F.when(F.length("text") > 500, F.lit("FAILURE")).otherwise(F.lit("SUCCESS")).alias("status"),
        (start + F.col("turn").cast("double") * F.lit(60.0)).alias("start_time"),
        (start + F.col("turn").cast("double") * F.lit(60.0) + F.length("text").cast("double") / F.lit(10.0)).alias(
            "end_time"
        ),
    )
    runs = conversations.groupBy("conv_id").agg(
        F.max(F.when(F.col("role") == "system", F.lit(1)).otherwise(F.lit(0))).alias("has_system"),
        F.sum(F.length("text")).alias("chars"),
    ).select(
        F.concat(F.lit("run-"), _text(F.col("conv_id"))).alias("run_id"),
        F.lit("snapshot_pipeline").alias("job"),
        F.when(F.col("has_system") == 1, F.lit("FAILURE")).otherwise(F.lit("SUCCESS")).alias("status"),
        (F.col("conv_id").cast("double") * F.lit(3600.0)).alias("start_time"),
        (F.col("conv_id").cast("double") * F.lit(3600.0) + F.col("chars").cast("double") / F.lit(10.0)).alias(
            "end_time"
        ),
    )
    return runs, steps
