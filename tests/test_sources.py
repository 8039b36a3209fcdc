"""Readers, listing and sinks on missing, empty and partitioned folders."""

import datetime as dt
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from snapflow.config import PipelineConfig
from snapflow.schemas import BRONZE, SILVER
from snapflow.sources.lake import list_files, object_store_conf, partition_date, read_bronze, read_silver
from snapflow.sources import tables
from snapflow.sources.sinks import append_snapshot, stage
from snapflow.sources.tables import PublishConflict, PublishError, drop_partitions, publish, read_table


def test_missing_roots_read_as_empty(spark, tmp_root):
    cfg = PipelineConfig(root=os.path.join(tmp_root, "nothing"))
    assert read_bronze(spark, cfg.bronze_path).count() == 0
    assert read_bronze(spark, cfg.bronze_path).schema == BRONZE
    assert read_silver(spark, cfg.silver_path).schema == SILVER
    assert list_files(spark, cfg.bronze_path).count() == 0


def test_partition_date_from_path(spark):
    df = spark.createDataFrame(
        [("s3a://b/bronze/date=2024-05-02/08-15-00.parquet",), ("s3a://b/other/x.parquet",)], "path string"
    )
    got = [r.d for r in df.select(partition_date("path").alias("d")).collect()]
    assert got == [dt.date(2024, 5, 2), None]


def test_object_store_settings():
    conf = object_store_conf("objects.local:9000")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "objects.local:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_append_one_file_per_snapshot_and_prune(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    append_snapshot(golden_bronze.where("date = DATE'2024-05-02'"), cfg.bronze_path)
    append_snapshot(golden_bronze.where("date = DATE'2024-05-01'"), cfg.bronze_path)
    files = [r.path for r in list_files(spark, cfg.bronze_path).collect()]
    assert len([p for p in files if "date=2024-05-02/" in p]) == 1
    day = read_bronze(spark, cfg.bronze_path).where("date = DATE'2024-05-01'")
    assert day.count() == 2  # stations A and I
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_partitioned_publish_replaces_only_staged_days(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    publish(spark, stage(golden_bronze, cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    only_day2 = golden_bronze.where("date = DATE'2024-05-02'").limit(1)
    publish(spark, stage(only_day2, cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    back = read_table(spark, cfg.silver_path, BRONZE)
    assert back.where("date = DATE'2024-05-01'").count() == 2  # untouched day kept
    assert back.where("date = DATE'2024-05-02'").count() == 1  # staged day replaced


def test_snapshot_file_named_after_poll_time(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    snap = golden_bronze.where("ingested_at = TIMESTAMP_NTZ'2024-05-02 08:15:00'")
    placed = append_snapshot(snap, cfg.bronze_path, file_stem="08-15-00", staging_root=cfg.staging_path)
    again = append_snapshot(snap, cfg.bronze_path, file_stem="08-15-00", staging_root=cfg.staging_path)
    assert [p.rsplit("/", 2)[-2:] for p in placed] == [["date=2024-05-02", "08-15-00.parquet"]]
    assert again[0].endswith("08-15-00-0-1.parquet")  # same second twice: both kept
    assert read_bronze(spark, cfg.bronze_path).count() == 2 * snap.count()
    assert os.listdir(cfg.staging_path) == []  # staged folders are gone after the renames


def test_failed_rename_leaves_table_and_staged_copy(spark, golden_bronze, tmp_root, monkeypatch):
    cfg = PipelineConfig(root=tmp_root)
    publish(spark, stage(golden_bronze, cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    staged = stage(golden_bronze.limit(3), cfg.staging_path, "date")
    before = sorted(os.listdir(staged))
    real, calls = tables.rename, []

    def failing(spark, fs, src, dst):
        calls.append(src)
        if len(calls) == 2:  # the second partition; the first has moved by then
            raise PublishError("no")
        real(spark, fs, src, dst)

    monkeypatch.setattr(tables, "rename", failing)
    two_days = stage(golden_bronze, cfg.staging_path, "date")
    with pytest.raises(PublishError):
        publish(spark, two_days, cfg.silver_path, partitioned=True)
    assert len(calls) == 2 and spark.read.parquet(two_days).count() == golden_bronze.count()
    monkeypatch.setattr(tables, "rename", real)
    assert read_table(spark, cfg.silver_path, BRONZE).count() == golden_bronze.count()
    assert sorted(os.listdir(staged)) == before


def test_rename_that_reports_false_is_an_error(spark, tmp_root):
    class Store:
        def exists(self, path):
            return False

        def rename(self, a, b):
            return False

    with pytest.raises(PublishError):
        tables.rename(spark, Store(), "a", "b")


def test_reader_of_an_older_version_can_finish(spark, golden_bronze, tmp_root):
    """Within the grace time a reader opened three publishes ago finishes; then the folders go."""
    path = os.path.join(tmp_root, "t")
    stage_root = os.path.join(tmp_root, "s")
    publish(spark, stage(golden_bronze.limit(5), stage_root), path)
    old = read_table(spark, path, BRONZE)
    for n in (2, 3, 4):
        publish(spark, stage(golden_bronze.limit(n), stage_root), path, grace=600)
    assert old.count() == 5 and read_table(spark, path, BRONZE).count() == 4
    hour_ago = time.time() - 3600
    manifests = os.path.join(path, tables.MANIFESTS)
    for name in sorted(os.listdir(manifests))[:3]:  # the first two were replaced an hour ago
        os.utime(os.path.join(manifests, name), (hour_ago, hour_ago))
    publish(spark, stage(golden_bronze.limit(1), stage_root), path, grace=600)
    versions = [d for d in os.listdir(path) if not d.startswith(("_", "."))]
    assert len(versions) == 3 and len(os.listdir(manifests)) == 3
    publish(spark, stage(golden_bronze.limit(6), stage_root), path, grace=0)
    versions = [d for d in os.listdir(path) if not d.startswith(("_", "."))]
    assert len(versions) == 1 and read_table(spark, path, BRONZE).count() == 6


def one_day(df, day):
    return df.where(F.col("date") == F.lit(day))


DAY1, DAY2 = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


def test_interleaved_publishes_of_two_days_both_stand(spark, golden_bronze, tmp_root):
    path, stage_root = os.path.join(tmp_root, "t"), os.path.join(tmp_root, "s")
    publish(spark, stage(golden_bronze, stage_root, "date"), path, partitioned=True)
    base = tables.manifest(spark, path)  # both writers begin here
    first = stage(one_day(golden_bronze, DAY1).limit(1), stage_root, "date")
    second = stage(one_day(golden_bronze, DAY2).limit(2), stage_root, "date")
    publish(spark, first, path, partitioned=True, base=base)
    publish(spark, second, path, partitioned=True, base=base)
    counts = {r["date"]: r["count"] for r in read_table(spark, path, BRONZE).groupBy("date").count().collect()}
    assert counts == {DAY1: 1, DAY2: 2}


@pytest.mark.parametrize("by", ["partition", "side", "depends"])
def test_interleaved_publishes_of_one_day_raise(spark, golden_bronze, tmp_root, by):
    path, stage_root = os.path.join(tmp_root, "t"), os.path.join(tmp_root, "s")
    publish(spark, stage(golden_bronze, stage_root, "date"), path, partitioned=True)
    base = tables.manifest(spark, path)
    side = {"_side": stage(golden_bronze.limit(1), stage_root)}
    publish(spark, stage(one_day(golden_bronze, DAY1).limit(1), stage_root, "date"), path, partitioned=True, base=base, side=side)
    staged = stage(one_day(golden_bronze, DAY1 if by == "partition" else DAY2).limit(2), stage_root, "date")
    other = stage(golden_bronze.limit(4), stage_root)
    with pytest.raises(PublishConflict):
        publish(
            spark, staged, path, partitioned=True, base=base,
            side={"_side": other} if by == "side" else None, depends=["date=2024-05-01"] if by == "depends" else [],
        )
    assert one_day(read_table(spark, path, BRONZE), DAY1).count() == 1
    assert spark.read.parquet(staged).count() == 2 and spark.read.parquet(other).count() == 4
    assert tables.read_side(spark, path, "_side").count() == 1


@pytest.mark.parametrize("store", ["link", "rename", "upload"])
def test_a_manifest_number_is_taken_once(spark, tmp_root, monkeypatch, store):
    """The three ways of creating a manifest, all tried on local files."""
    if store == "upload":
        monkeypatch.setattr(tables, "UPLOADS", ("file",))
    if store == "rename":
        monkeypatch.setattr(tables, "LINKS", ())
    path = os.path.join(tmp_root, "t")
    body = {"number": 1, "parts": {"": "a"}, "writer": "one"}
    assert tables._taken(spark, path, body)
    assert not tables._taken(spark, path, {**body, "parts": {"": "b"}, "writer": "two"})
    assert tables._taken(spark, path, body)  # an answer lost on the way counts as done
    assert tables.manifest(spark, path)["parts"] == {"": "a"}
    assert [f for f in os.listdir(os.path.join(path, tables.MANIFESTS)) if f.endswith(".tmp")] == []


def test_writers_at_once_lose_no_commit(spark, golden_bronze, tmp_root):
    path, stage_root = os.path.join(tmp_root, "t"), os.path.join(tmp_root, "s")
    sides = {f"_side{k}": stage(golden_bronze.limit(k + 1), stage_root) for k in range(6)}
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda kv: publish(spark, None, path, partitioned=True, side=dict([kv])), sides.items()))
    assert sorted(tables.manifest(spark, path)["parts"]) == sorted(sides)
    assert tables.manifest(spark, path)["number"] == 6


def test_dropped_partition_is_gone(spark, golden_bronze, tmp_root):
    path = os.path.join(tmp_root, "t")
    publish(spark, stage(golden_bronze, os.path.join(tmp_root, "s"), "date"), path, partitioned=True)
    drop_partitions(spark, path, {"date=2024-05-01"})
    assert {r["date"] for r in read_table(spark, path, BRONZE).select("date").distinct().collect()} == {dt.date(2024, 5, 2)}
    assert not os.path.exists(os.path.join(path, "date=2024-05-01"))


def test_few_files_per_day_whatever_the_shuffle_width(spark, golden_bronze, tmp_root):
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        wide = golden_bronze.repartition(40, "stationcode")
        staged = stage(wide, os.path.join(tmp_root, "s"), "date", sort_by=["stationcode"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for day in ("date=2024-05-01", "date=2024-05-02"):
        assert len([f for f in os.listdir(os.path.join(staged, day)) if f.endswith(".parquet")]) <= 2
