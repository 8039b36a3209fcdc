"""Writers: snapshot append, staging of whole tables, JSON output (publishing: ``tables``)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from snapflow.sources.tables import rename


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def append_snapshot(
    df: DataFrame,
    bronze_root: str,
    files: int = 1,
    file_stem: str | None = None,
    staging_root: str | None = None,
) -> list[str]:
    """Append one polled snapshot under ``date=D/``.

    A snapshot is one poll of the feed (bounded by the number of stations),
    so writing it as ``files`` file(s) keeps one file per snapshot.  With
    ``file_stem`` (e.g. ``HH-MM-SS`` of the poll) the single file is written to
    staging first and renamed to ``date=D/<file_stem>.parquet``.
    """
    if file_stem is None:
        df.coalesce(files).write.mode("append").partitionBy("date").parquet(bronze_root)
        return []
    spark = df.sparkSession
    staged = stage(df.coalesce(1), staging_root or f"{bronze_root.rstrip('/')}_staging", partition_by="date")
    fs, src = _fs(spark, staged)
    jvm = spark.sparkContext._jvm
    placed = []
    for part in fs.listStatus(src):
        if not part.isDirectory() or not part.getPath().getName().startswith("date="):
            continue
        target_dir = jvm.org.apache.hadoop.fs.Path(f"{bronze_root.rstrip('/')}/{part.getPath().getName()}")
        fs.mkdirs(target_dir)
        for k, f in enumerate(x for x in fs.listStatus(part.getPath()) if x.getPath().getName().endswith(".parquet")):
            name = f"{file_stem}.parquet" if k == 0 else f"{file_stem}-{k}.parquet"
            target = jvm.org.apache.hadoop.fs.Path(target_dir, name)
            n = 1
            while fs.exists(target):  # two polls in the same second: keep both
                target = jvm.org.apache.hadoop.fs.Path(target_dir, f"{file_stem}-{k}-{n}.parquet")
                n += 1
            rename(spark, fs, f.getPath(), target)
            placed.append(target.toString())
    fs.delete(src, True)
    return placed


def stage(df: DataFrame, staging_root: str, partition_by: str | None = None, sort_by: Sequence[str] = ()) -> str:
    """Write ``df`` to a fresh staging folder and return it (lineage ends there).

    Partitioned output is rebalanced by the partition column first, so a
    partition gets files of the advisory size instead of one per shuffle task,
    and a large one is still split.  ``sort_by`` orders the rows inside the
    files (row-group statistics then prune by those columns).
    """
    path = f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_by)
        df.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def staged_dates(spark: SparkSession, staged: str) -> list:
    """The ``date=`` partition values present in a staged folder (a listing, no job)."""
    import datetime as dt

    fs, src = _fs(spark, staged)
    if not fs.exists(src):
        return []
    out = []
    for status in fs.listStatus(src):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("date="):
            value = name[len("date="):]
            out.append(None if value == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(value))
    return sorted(out, key=lambda d: (d is None, d or dt.date.min))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staging folder once its content is published."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def write_json(df: DataFrame, path: str) -> None:
    """Write a (small) result as JSON lines, replacing the folder."""
    df.write.mode("overwrite").json(path)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged folder in the place of another by two checked renames.

    The old folder is set aside, not deleted, until the new one stands; if the
    second rename fails the first is undone.
    """
    fs, src = _fs(spark, staged)
    _, dst = _fs(spark, target)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst.getParent(), f"_old-{uuid.uuid4().hex}")
    rename(spark, fs, dst, aside)
    try:
        rename(spark, fs, src, dst)
    except BaseException:
        rename(spark, fs, aside, dst)
        raise
    fs.delete(aside, True)
