"""Age-based retention: plan the expired set as a DataFrame, then delete.

Bronze expires by the ``date=`` of its partition folder (midnight of that
day older than now - 7 days), silver and gold by file modification time
(older than now - 30 days).  Naive times are UTC everywhere.  Paths without ``date=`` are never expired by the
partition rule.  ``dry_run`` is the default everywhere.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.config import GOLD_TABLES, PipelineConfig
from snapflow.functions.exprs import ntz_literal
from snapflow.sources.lake import list_files, partition_date
from snapflow.sources.tables import drop_partitions, exists, manifest, partitions


def _naive(now: dt.datetime) -> dt.datetime:
    return now.astimezone(dt.timezone.utc).replace(tzinfo=None) if now.tzinfo else now


def plan_partition_expiry(listing: DataFrame, now: dt.datetime, days: int) -> DataFrame:
    """path, partition_date, expired — expired when midnight(date) < now - days."""
    cutoff = ntz_literal(_naive(now) - dt.timedelta(days=days))
    d = partition_date("path")
    expired = F.coalesce(d.cast("timestamp_ntz") < cutoff, F.lit(False))
    return listing.select("path", d.alias("partition_date"), expired.alias("expired"))


def plan_mtime_expiry(listing: DataFrame, now: dt.datetime, days: int) -> DataFrame:
    """path, modificationTime, expired — expired when mtime < now - days (instants)."""
    aware = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    cutoff = F.timestamp_seconds(F.lit((aware - dt.timedelta(days=days)).timestamp()))
    return listing.select(
        "path", "modificationTime", F.coalesce(F.col("modificationTime") < cutoff, F.lit(False)).alias("expired")
    )


def _delete(spark: SparkSession, paths, recursive: bool) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        hpath.getFileSystem(conf).delete(hpath, recursive)


def expired_folders(plan: DataFrame, root: str) -> DataFrame:
    """``folder, n``: folders right under ``root`` in which every file is expired, with their number of files.

    One row per day (or table version), whatever the number of files.
    """
    name = F.regexp_extract("path", re.escape(_bare(root)) + r"/([^/]+)/", 1)
    per = plan.where(name != "").groupBy(name.alias("folder")).agg(F.min("expired").alias("all"), F.count(F.lit(1)).alias("n"))
    return per.where("all").select("folder", "n")


def _bare(root: str) -> str:
    """A path without scheme and host, as far as they can differ between listing and configuration."""
    return "/" + re.sub(r"^[a-z0-9]+:/*", "", root.rstrip("/")).lstrip("/")


def apply_expiry(spark: SparkSession, plan: DataFrame, root: str, dry_run: bool = True) -> int:
    """Delete what ``plan`` marks expired under ``root``; return the number of expired files.

    A folder whose files have all expired goes with one call; the folder names
    are all that reaches the driver.  A published table drops the partition
    from its manifest first.  Expired files in folders that also hold younger
    ones (left-overs of a replaced version) are deleted one by one.
    """
    n = plan.where("expired").count()
    if dry_run or n == 0:
        return n
    folders = {r["folder"] for r in expired_folders(plan, root).collect()}
    inside = F.regexp_extract("path", re.escape(_bare(root)) + r"/([^/]+)/", 1)
    rest = plan.where("expired").where(~inside.isin(list(folders)) if folders else F.lit(True))
    # The listing is lazy, so it is read to the end before any folder goes.
    _delete(spark, (r["path"] for r in rest.select("path").toLocalIterator()), False)
    current = set(manifest(spark, root)["parts"])
    drop_partitions(spark, root, {f for f in folders if f in current})
    _delete(spark, (f"{root.rstrip('/')}/{f}" for f in folders), True)
    return n


def run_cleanup(spark: SparkSession, cfg: PipelineConfig, now: dt.datetime, dry_run: bool = True) -> DataFrame:
    """Apply all three rules; return (layer, deleted) rows.

    A mart is one folder per version, so an expired mart loses its current
    version and reads as empty until the next tick.
    """
    bronze = plan_partition_expiry(list_files(spark, cfg.bronze_path), now, cfg.bronze_days)
    silver = plan_mtime_expiry(list_files(spark, cfg.silver_path), now, cfg.silver_days)
    counts = [
        ("bronze", apply_expiry(spark, bronze, cfg.bronze_path, dry_run)),
        ("silver", apply_expiry(spark, silver, cfg.silver_path, dry_run)),
    ]
    gold = 0
    for name in GOLD_TABLES:
        path = cfg.gold_path(name)
        plan = plan_mtime_expiry(list_files(spark, path), now, cfg.gold_days)
        if not dry_run and exists(spark, path) and partitions(spark, path):
            version = manifest(spark, path)["parts"][""]
            if any(r["folder"] == version for r in expired_folders(plan, path).collect()):
                drop_partitions(spark, path, {""})
        gold += apply_expiry(spark, plan, path, dry_run)
    counts.append(("gold", gold))
    return spark.createDataFrame(counts, "layer string, deleted long")


def clean_staging(
    spark: SparkSession, cfg: PipelineConfig, now: dt.datetime, days: int = 1, dry_run: bool = True
) -> int:
    """Remove staging folders left by runs that died before publishing.

    A staging folder lives for one publish; one older than ``days`` is
    garbage.  Only the top-level folder names are listed (metadata, bounded
    by the number of interrupted runs).
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(cfg.staging_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    aware = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    cutoff_ms = (aware - dt.timedelta(days=days)).timestamp() * 1000
    old = [st.getPath() for st in fs.listStatus(root) if st.getModificationTime() < cutoff_ms]
    if not dry_run:
        for path in old:
            fs.delete(path, True)
    return len(old)
