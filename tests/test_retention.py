"""Retention boundaries, foreign paths, dry run and deletion."""

import datetime as dt
import os
import time

from snapflow.config import PipelineConfig
from snapflow.plans.retention import apply_expiry, clean_staging, plan_mtime_expiry, plan_partition_expiry, run_cleanup
from snapflow.sources.lake import list_files


def listing(spark, paths):
    return spark.createDataFrame([(p, None, 1) for p in paths], "path string, modificationTime timestamp, length long")


def test_partition_expiry_at_two_am(spark):
    now = dt.datetime(2024, 5, 10, 2, 0)
    days = [dt.date(2024, 5, 10) - dt.timedelta(days=k) for k in range(0, 9)]  # N .. N-8
    paths = [f"b/date={d.isoformat()}/00-00-00.parquet" for d in days] + ["b/other/file.parquet"]
    plan = {r.path: r.expired for r in plan_partition_expiry(listing(spark, paths), now, 7).collect()}
    expired = {p for p, e in plan.items() if e}
    assert expired == {f"b/date={d.isoformat()}/00-00-00.parquet" for d in days[7:]}  # N-7, N-8
    assert plan["b/other/file.parquet"] is False


def test_partition_expiry_exact_boundary(spark):
    day = "b/date=2024-05-03/x.parquet"
    at = plan_partition_expiry(listing(spark, [day]), dt.datetime(2024, 5, 10, 0, 0), 7).first().expired
    after = plan_partition_expiry(listing(spark, [day]), dt.datetime(2024, 5, 10, 0, 0, 1), 7).first().expired
    assert at is False and after is True


def test_mtime_expiry_and_apply(spark, tmp_root):
    root = os.path.join(tmp_root, "silver")
    os.makedirs(os.path.join(root, "date=2024-01-01"))
    old = os.path.join(root, "date=2024-01-01", "old.parquet")
    new = os.path.join(root, "date=2024-01-01", "new.parquet")
    for p in (old, new):
        with open(p, "wb") as f:
            f.write(b"x")
    past = time.time() - 40 * 86400
    os.utime(old, (past, past))
    now = dt.datetime.now(dt.timezone.utc)
    plan = plan_mtime_expiry(list_files(spark, root), now, 30)
    marked = {os.path.basename(r.path): r.expired for r in plan.collect()}
    assert marked == {"old.parquet": True, "new.parquet": False}
    assert apply_expiry(spark, plan, root, dry_run=True) == 1
    assert os.path.exists(old)
    assert apply_expiry(spark, plan, root, dry_run=False) == 1
    assert not os.path.exists(old) and os.path.exists(new)


def test_run_cleanup_bronze_folders(spark, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    for d in ("2024-05-01", "2024-05-09"):
        folder = os.path.join(cfg.bronze_path, f"date={d}")
        os.makedirs(folder)
        with open(os.path.join(folder, "10-00-00.parquet"), "wb") as f:
            f.write(b"x")
    now = dt.datetime(2024, 5, 10, 2, 0)
    dry = {r.layer: r.deleted for r in run_cleanup(spark, cfg, now).collect()}
    assert dry == {"bronze": 1, "silver": 0, "gold": 0}
    assert os.path.exists(os.path.join(cfg.bronze_path, "date=2024-05-01"))
    run_cleanup(spark, cfg, now, dry_run=False).collect()
    assert not os.path.exists(os.path.join(cfg.bronze_path, "date=2024-05-01"))
    assert os.path.exists(os.path.join(cfg.bronze_path, "date=2024-05-09"))


def test_clean_staging(spark, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    old, fresh = os.path.join(cfg.staging_path, "dead"), os.path.join(cfg.staging_path, "live")
    for d in (old, fresh):
        os.makedirs(d)
    past = time.time() - 3 * 86400
    os.utime(old, (past, past))
    now = dt.datetime.now(dt.timezone.utc)
    assert clean_staging(spark, cfg, now) == 1 and os.path.exists(old)
    assert clean_staging(spark, cfg, now, dry_run=False) == 1
    assert not os.path.exists(old) and os.path.exists(fresh)


def test_expired_silver_days_leave_the_manifest(spark, golden_bronze, tmp_root):
    from snapflow.plans.pipeline import refresh_silver
    from snapflow.sources.lake import read_silver
    from snapflow.sources.sinks import append_snapshot

    cfg = PipelineConfig(root=tmp_root)
    append_snapshot(golden_bronze, cfg.bronze_path)
    refresh_silver(spark, cfg)
    past = time.time() - 40 * 86400
    for base, _, files in os.walk(os.path.join(cfg.silver_path, "date=2024-05-01")):
        for f in files:
            os.utime(os.path.join(base, f), (past, past))
    now = dt.datetime.now(dt.timezone.utc)
    counts = {r.layer: r.deleted for r in run_cleanup(spark, cfg, now, dry_run=False).collect()}
    assert counts["silver"] >= 1
    assert {r["date"] for r in read_silver(spark, cfg.silver_path).select("date").distinct().collect()} == {dt.date(2024, 5, 2)}


def test_naive_now_is_utc(spark):
    listing_ = spark.sql("SELECT 'a/b.parquet' AS path, TIMESTAMP '2024-05-01 00:00:00' AS modificationTime, 1L AS length")
    for now in (dt.datetime(2024, 5, 31, 0, 0, 1), dt.datetime(2024, 5, 31, 2, 0, 1, tzinfo=dt.timezone(dt.timedelta(hours=2)))):
        assert plan_mtime_expiry(listing_, now, 30).first().expired is True
    assert plan_mtime_expiry(listing_, dt.datetime(2024, 5, 31), 30).first().expired is False
