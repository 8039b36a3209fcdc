"""Run log of the pipeline and the run-status query on it."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.config import STEP_SUFFIX, PipelineConfig
from snapflow.functions.exprs import duration_seconds
from snapflow.schemas import RUN_LOG
from snapflow.sources.lake import path_exists
from snapflow.sources.sinks import remove, replace_folder, stage


class RunRecorder:
    """Collects step timings of one run; ``finish`` appends one run-log row."""

    def __init__(self, job: str):
        self.run_id = uuid.uuid4().hex
        self.job = job
        self.start_time = time.time()
        self.steps: list[tuple[str, str, float, float | None]] = []

    def step(self, key: str):
        recorder = self

        class _Step:
            def __enter__(self):
                self.t0 = time.time()
                return self

            def __exit__(self, exc_type, exc, tb):
                status = "SUCCESS" if exc_type is None else "FAILURE"
                recorder.steps.append((f"{key}{STEP_SUFFIX}", status, self.t0, time.time()))
                return False

        return _Step()

    def finish(self, spark: SparkSession, cfg: PipelineConfig, status: str) -> None:
        """Append this run as one row, in the folder of its (UTC) start day."""
        day = dt.datetime.fromtimestamp(self.start_time, dt.timezone.utc).date()
        row = (self.run_id, self.job, status, self.start_time, time.time(), [s for s in self.steps], day)
        spark.createDataFrame([row], RUN_LOG_STORED).coalesce(1).write.mode("append").partitionBy("day").parquet(
            cfg.runlog_path
        )


# Stored form: the run-log record plus its start ``day`` (the partition column).
RUN_LOG_STORED = T.StructType(RUN_LOG.fields + [T.StructField("day", T.DateType(), True)])


def read_run_log(spark: SparkSession, cfg: PipelineConfig, since: dt.date | None = None) -> DataFrame:
    """Run-log records; with ``since`` only day folders from that day on are read."""
    if not path_exists(spark, cfg.runlog_path):
        return spark.createDataFrame([], RUN_LOG)
    log = spark.read.schema(RUN_LOG_STORED).option("basePath", cfg.runlog_path).parquet(cfg.runlog_path)
    if since is not None:
        log = log.where(F.col("day") >= F.lit(since))
    return log.select(*RUN_LOG.fieldNames())


def compact_run_log(spark: SparkSession, cfg: PipelineConfig, before: dt.date) -> int:
    """Rewrite each finished day folder (day < ``before``) that holds several
    files as a single file; already compacted days are left alone.

    Each run appends one small file; compaction keeps the listing small.  A
    day holds at most a few hundred runs, so one file per day is bounded.
    Returns the number of day folders rewritten.
    """
    todo = [d for d, n in _day_file_counts(spark, cfg.runlog_path).items() if d < before and n > 1]
    if not todo:
        return 0
    log = spark.read.schema(RUN_LOG_STORED).option("basePath", cfg.runlog_path).parquet(cfg.runlog_path)
    staged = stage(log.where(F.col("day").isin(todo)), cfg.staging_path, partition_by="day")
    for day in todo:
        replace_folder(spark, f"{staged}/day={day.isoformat()}", f"{cfg.runlog_path}/day={day.isoformat()}")
    remove(spark, staged)
    return len(todo)


def _day_file_counts(spark: SparkSession, root: str) -> dict[dt.date, int]:
    """Parquet files per ``day=`` folder (a listing of metadata only)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return {}
    out = {}
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("day="):
            files = [f for f in fs.listStatus(st.getPath()) if f.getPath().getName().endswith(".parquet")]
            out[dt.date.fromisoformat(name[len("day="):])] = len(files)
    return out


def split_run_log(run_log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested run log -> (runs, steps) with a step ``position``."""
    runs = run_log.select("run_id", "job", "status", "start_time", "end_time")
    steps = run_log.select("run_id", F.posexplode("steps").alias("position", "s")).select(
        "run_id", "position", "s.step_key", "s.status", "s.start_time", "s.end_time"
    )
    return runs, steps


def _newest_run(runs: DataFrame, job: str) -> DataFrame:
    """One row: the newest run of ``job`` (NULL fields when there is none)."""
    order = F.struct(F.col("start_time"), F.col("run_id"))
    pick = F.struct("run_id", "status", "start_time", "end_time")
    return runs.where(F.col("job") == job).agg(F.max_by(pick, order).alias("r")).select("r.*")


def run_step_status(runs: DataFrame, steps: DataFrame, job: str) -> DataFrame:
    """Flat run status: one row per asset of the newest run.

    Columns: run_id, status, started_at, ended_at, duration_seconds, asset,
    asset_status, asset_duration_seconds.  The asset is the step key with
    every ``_1`` removed; of duplicate assets the later step wins.
    """
    newest = _newest_run(runs, job)
    # One row by construction, so broadcasting it is size-safe.
    mine = steps.join(F.broadcast(newest.select("run_id")), "run_id")
    with_asset = mine.withColumn("asset", F.replace(F.col("step_key"), F.lit(STEP_SUFFIX), F.lit("")))
    w = Window.partitionBy("asset").orderBy(F.col("position").desc())
    last = with_asset.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    assets = last.select(
        "run_id",
        "asset",
        F.col("status").alias("asset_status"),
        duration_seconds("start_time", "end_time").alias("asset_duration_seconds"),
    )
    head = newest.select(
        "run_id",
        "status",
        F.col("start_time").alias("started_at"),
        F.col("end_time").alias("ended_at"),
        duration_seconds("start_time", "end_time").alias("duration_seconds"),
    )
    return assets.join(F.broadcast(head), "run_id").select(
        "run_id",
        "status",
        "started_at",
        "ended_at",
        "duration_seconds",
        "asset",
        "asset_status",
        "asset_duration_seconds",
    )


def run_status(runs: DataFrame, steps: DataFrame, job: str) -> DataFrame:
    """API shape in one row: run_id, status, started_at, ended_at,
    duration_seconds, assets map<asset, struct<status, duration_seconds>>.

    With no run: status ``no_runs`` and an empty map.  The map gathers the
    steps of one run only (a job has a fixed, small set of steps).
    """
    newest = _newest_run(runs, job)
    per_step = steps.join(F.broadcast(newest.select("run_id")), "run_id").select(
        "run_id",
        F.struct(
            F.col("position"),
            F.replace(F.col("step_key"), F.lit(STEP_SUFFIX), F.lit("")).alias("asset"),
            F.struct(
                F.col("status").alias("status"),
                duration_seconds("start_time", "end_time").alias("duration_seconds"),
            ).alias("info"),
        ).alias("e"),
    )
    gathered = per_step.groupBy("run_id").agg(F.array_sort(F.collect_list("e")).alias("entries"))
    assets = F.coalesce(
        F.map_from_entries(F.transform(F.col("entries"), lambda e: F.struct(e["asset"], e["info"]))),
        F.create_map().cast("map<string,struct<status:string,duration_seconds:double>>"),
    )
    return newest.join(gathered, "run_id", "left").select(
        "run_id",
        F.coalesce(F.col("status"), F.lit("no_runs")).alias("status"),
        F.col("start_time").alias("started_at"),
        F.col("end_time").alias("ended_at"),
        duration_seconds("start_time", "end_time").alias("duration_seconds"),
        assets.alias("assets"),
    )


def run_status_text(status: DataFrame) -> DataFrame:
    """``run_status`` with its map as text, ``asset=status/seconds`` in asset order."""
    entry = lambda e: F.concat_ws("", e["key"], F.lit("="), e["value"]["status"], F.lit("/"), e["value"]["duration_seconds"].cast("string"))
    entries = F.array_sort(F.transform(F.map_entries("assets"), entry))
    return status.withColumn("assets", F.concat_ws(";", entries))
