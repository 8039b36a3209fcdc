"""One pipeline tick: ingest -> silver -> data tests -> publish -> gold -> run log.

Each table is written to a staging folder first.  Silver is tested *before*
it is published, so a failed error-severity test leaves the previous silver
and gold in place and stops the tick (the gate).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.config import GOLD_TABLES, PipelineConfig
from snapflow.functions.exprs import utc_now
from snapflow.operators.lag import heavy_keys, key_sketches
from snapflow.plans import gold as gold_plans
from snapflow.plans import insights
from snapflow.plans.latest import keep_newest, read_newest
from snapflow.plans.quality import gate_silver, log_silver
from snapflow.plans.runlog import RunRecorder
from snapflow.plans.silver import build_silver, build_silver_after
from snapflow.schemas import GOLD_SCHEMAS, LATEST, POSITIONS, SILVER, SKETCHES, SOURCE_COLUMNS
from snapflow.sources.lake import bronze_dates, list_files, read_bronze, read_silver
from snapflow.sources.landing import read_landed_json, to_bronze
from snapflow.sources.sinks import append_snapshot, stage, staged_dates, write_json
from snapflow.sources.tables import manifest, partitions, publish, read_side, read_table, side_of


def ingest(
    spark: SparkSession, cfg: PipelineConfig, landed_path: str, ingested_at: dt.datetime, layout: str = "array"
) -> None:
    """Landed JSON snapshot -> one bronze file ``date=<day>/<HH-MM-SS>.parquet`` of the ingest stamp."""
    append_snapshot(
        to_bronze(read_landed_json(spark, landed_path, layout), ingested_at),
        cfg.bronze_path,
        file_stem=ingested_at.strftime("%H-%M-%S"),
        staging_root=cfg.staging_path,
    )


def refresh_silver(spark: SparkSession, cfg: PipelineConfig) -> list[dict]:
    """Full rebuild of silver from all bronze, tested on the staged copy, then published.

    Days whose bronze has expired keep their silver rows, and serve as
    predecessors of the rebuilt days: expiry changes no LAG value.  The
    heavy-hitter sketches of the days, kept with the table, tell the next
    rebuild which stations to split.  The position table of the merge and the
    newest rows of the rebuilt days no longer hold; they are made anew when next
    needed.  Raises ``PublishConflict`` if a merge publishes meanwhile.
    """
    base = manifest(spark, cfg.silver_path)
    bronze, days = read_bronze(spark, cfg.bronze_path, sources=True), bronze_dates(spark, cfg.bronze_path)
    sketches = read_side(spark, cfg.silver_path, SKETCHES)
    hot = heavy_keys(sketches, "station_code") if sketches is not None else None
    if days and any(p < f"date={days[0].isoformat()}" for p in partitions(spark, cfg.silver_path)):
        history = read_silver(spark, cfg.silver_path).where(F.col("date") < F.lit(days[0]))
        silver = build_silver_after(history, bronze, cfg, SOURCE_COLUMNS, hot)
    else:
        silver = build_silver(bronze, cfg, SOURCE_COLUMNS, hot)
    staged = stage(silver, cfg.staging_path, partition_by="date", sort_by=["station_code"])
    built = spark.read.schema(SILVER).option("basePath", staged).parquet(staged)
    report = gate_silver(built) if cfg.stop_on_failed_tests else log_silver(built)
    fresh = key_sketches(built, "station_code", ["date"])
    if sketches is not None:  # days without bronze keep theirs
        fresh = fresh.unionByName(sketches.join(fresh.select("date"), "date", "left_anti"))
    side = {SKETCHES: stage(fresh, cfg.staging_path)}
    newest = [side_of(LATEST, str(d)) for d in staged_dates(spark, staged)]
    publish(spark, staged, cfg.silver_path, partitioned=True, side=side, stale=[POSITIONS, *newest], base=base)
    return report


def refresh_gold(spark: SparkSession, cfg: PipelineConfig, as_of: dt.date) -> None:
    """Each mart has one row per station or district; a rebalance makes its files, after the work is done in parallel."""
    keep_newest(spark, cfg, as_of)
    silver, latest = read_silver(spark, cfg.silver_path), read_newest(spark, cfg, as_of)
    for name in GOLD_TABLES:
        base = manifest(spark, cfg.gold_path(name))
        out = gold_plans.build_gold(silver, latest, name, as_of, cfg)
        publish(spark, stage(out, cfg.staging_path), cfg.gold_path(name), base=base)


def run_pipeline(
    spark: SparkSession,
    cfg: PipelineConfig,
    as_of: dt.date,
    landed_path: str | None = None,
    ingested_at: dt.datetime | None = None,
    incremental: bool = False,
    layout: str = "array",
) -> list[dict]:
    """Run one tick and append its record to the run log; re-raise any failure.

    ``incremental=True`` merges only the new bronze files into silver (same
    result, same gate) instead of rebuilding it from all bronze.
    """
    rec = RunRecorder(cfg.job)
    status = "FAILURE"
    report: list[dict] = []
    try:
        if landed_path is not None:
            with rec.step("bronze"):
                ingest(spark, cfg, landed_path, ingested_at or utc_now(), layout)
        with rec.step("silver"):
            if incremental:
                from snapflow.streaming.incremental import start_incremental

                start_incremental(spark, cfg)
            else:
                report = refresh_silver(spark, cfg)
        with rec.step("gold"):
            refresh_gold(spark, cfg, as_of)
        status = "SUCCESS"
        return report
    finally:
        rec.finish(spark, cfg, status)


def read_gold(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    """One mart, with its declared schema; read it in ``gold_plans.gold_order``."""
    return read_table(spark, cfg.gold_path(name), GOLD_SCHEMAS[name])


def read_gold_ordered(spark: SparkSession, cfg: PipelineConfig, name: str) -> DataFrame:
    """One mart in its reading order."""
    return read_gold(spark, cfg, name).orderBy(*gold_plans.gold_order(name))


def serve_insights(spark: SparkSession, cfg: PipelineConfig, as_of: dt.date) -> dict[str, DataFrame]:
    """The insight queries over the stored layers (silver pruned to one date partition, or its newest rows)."""
    silver, latest = read_silver(spark, cfg.silver_path), read_newest(spark, cfg, as_of)
    return {
        # Only the day's folder is listed, not the whole bronze tree.
        "snapshot_metrics": insights.snapshot_metrics(
            insights.snapshots_from_listing(list_files(spark, f"{cfg.bronze_path}/date={as_of.isoformat()}"), as_of),
            silver,
            as_of,
        ),
        "summary": insights.network_summary_of(latest),
        "at_risk": insights.top_at_risk(read_gold(spark, cfg, "stations_at_risk"), cfg.top_at_risk, with_rank=True),
        "districts": insights.ordered_districts(read_gold(spark, cfg, "district_stats")),
        "top_depletion": insights.top_depletion_of(latest, cfg.top_depletion, with_rank=True),
        "empty_duration": insights.top_empty(read_gold(spark, cfg, "stations_empty_duration"), cfg.top_empty, with_rank=True),
    }


def export_insights(spark: SparkSession, cfg: PipelineConfig, as_of: dt.date, out_root: str) -> list[str]:
    """Write every insight result as JSON lines under ``out_root/<name>`` (small, bounded outputs)."""
    paths = []
    for name, df in serve_insights(spark, cfg, as_of).items():
        path = f"{out_root.rstrip('/')}/{name}"
        write_json(df.coalesce(1), path)
        paths.append(path)
    return paths
