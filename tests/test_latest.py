"""The kept newest rows of a day equal what the day's silver gives, whatever is merged in which order."""

import datetime as dt
import random

import pytest

from snapflow.config import PipelineConfig
from snapflow.plans import gold, insights
from snapflow.plans.latest import keep_newest, kept_newest, newest_of_days, read_newest, side_name
from snapflow.plans.pipeline import read_gold, refresh_gold, refresh_silver, serve_insights
from snapflow.plans.retention import apply_expiry, plan_partition_expiry
from snapflow.plans.silver import build_silver
from snapflow.schemas import BRONZE, POSITIONS
from snapflow.sources.lake import list_files, read_silver, read_stored_silver
from snapflow.sources.sinks import append_snapshot, stage
from snapflow.sources.tables import PublishConflict, drop_partitions, manifest, publish
from snapflow.streaming import incremental
from test_incremental import merge_file, rows_of

AS_OF = dt.date(2024, 5, 2)
DAYS = [dt.date(2024, 5, 1), AS_OF]


def assert_kept(spark, cfg, days=DAYS):
    silver = read_silver(spark, cfg.silver_path)
    for day in days:
        kept = kept_newest(spark, cfg.silver_path, day)
        want = gold.latest_of_day(silver, day)
        assert rows_of(kept.select(*want.columns)) == rows_of(want), day
        assert all(f"/{side_name(day)}/" in f for f in kept.inputFiles())


def test_merges_in_any_order(spark, golden_bronze, tmp_root):
    """Late files, and a file again, leave each day's newest rows right."""
    rows = [tuple(r) for r in golden_bronze.collect()]
    random.Random(2).shuffle(rows)
    cfg = PipelineConfig(root=tmp_root)
    for k, name in enumerate(["a", "b", "c", "b"]):
        merge_file(spark, cfg, name, rows[8 * (k % 3) :][:8] if name != "b" else rows[8:16])
        there = [d for d in DAYS if f"date={d}" in manifest(spark, cfg.silver_path)["parts"]]
        assert_kept(spark, cfg, there)
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(golden_bronze))


def test_equal_rows_and_a_row_between(spark, golden_bronze, tmp_root):
    """A repeated newest row, then one that comes between it and its predecessor."""
    rows = [tuple(r) for r in golden_bronze.where("stationcode = 'A'").collect()]
    rows.sort(key=lambda r: r[15])
    cfg = PipelineConfig(root=tmp_root)
    merge_file(spark, cfg, "a", [rows[0], rows[2], rows[2]])
    assert_kept(spark, cfg)
    merge_file(spark, cfg, "b", [rows[1]])
    assert_kept(spark, cfg)
    (newest,) = kept_newest(spark, cfg.silver_path, AS_OF).collect()
    assert (newest.bikes_available, newest.bikes_delta) == (4, -6)


def test_reports_read_the_kept_rows(spark, golden_bronze, tmp_root):
    """Marts and insights equal those from whole silver; a rebuilt day is kept anew by the first report."""
    cfg = PipelineConfig(root=tmp_root)
    append_snapshot(golden_bronze, cfg.bronze_path)
    refresh_silver(spark, cfg)
    assert kept_newest(spark, cfg.silver_path, AS_OF) is None
    refresh_gold(spark, cfg, AS_OF)
    assert_kept(spark, cfg, [AS_OF])
    silver = build_silver(golden_bronze)
    assert rows_of(read_gold(spark, cfg, "stations_at_risk")) == rows_of(gold.stations_at_risk(silver, AS_OF))
    assert rows_of(read_gold(spark, cfg, "district_stats")) == rows_of(gold.district_stats(silver, AS_OF))
    served = serve_insights(spark, cfg, AS_OF)
    assert rows_of(served["summary"]) == rows_of(insights.network_summary(silver, AS_OF))
    assert not [f for f in served["summary"].inputFiles() if "/date=" in f]
    refresh_silver(spark, cfg)
    assert kept_newest(spark, cfg.silver_path, AS_OF) is None  # no longer vouched for


def test_merge_after_a_rebuild_and_an_empty_day(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    rows = [tuple(r) for r in golden_bronze.collect()]
    spark.createDataFrame(rows[:20], BRONZE).coalesce(1).write.partitionBy("date").parquet(cfg.bronze_path)
    refresh_silver(spark, cfg)
    merge_file(spark, cfg, "late", rows[20:])
    assert_kept(spark, cfg, [AS_OF])
    nothing = dt.date(2030, 1, 1)
    keep_newest(spark, cfg, nothing)
    assert read_newest(spark, cfg, nothing).count() == 0
    assert side_name(nothing) not in manifest(spark, cfg.silver_path)["parts"]


def test_dropped_day_takes_its_rows_along(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    merge_file(spark, cfg, "a", [tuple(r) for r in golden_bronze.collect()])
    drop_partitions(spark, cfg.silver_path, {"date=2024-05-01"})
    assert sorted(manifest(spark, cfg.silver_path)["parts"]) == [side_name(AS_OF), "date=2024-05-02"]
    assert_kept(spark, cfg, [AS_OF])
    expiry = plan_partition_expiry(list_files(spark, cfg.silver_path), dt.datetime(2024, 6, 1), 7)
    apply_expiry(spark, expiry, cfg.silver_path, dry_run=False)
    assert manifest(spark, cfg.silver_path)["parts"] == {}
    assert read_newest(spark, cfg, AS_OF).count() == 0


def test_two_merges_at_once_both_count(spark, golden_bronze, tmp_root, monkeypatch):
    """A merge that another one overtakes starts again from what that one left."""
    cfg = PipelineConfig(root=tmp_root)
    rows = [tuple(r) for r in golden_bronze.collect()]
    merge_file(spark, cfg, "a", rows[:8])
    real, calls = incremental._publish_tested, []

    def overtaken(*args):
        calls.append(1)
        if len(calls) == 1:
            merge_file(spark, cfg, "b", rows[8:16])
        real(*args)

    monkeypatch.setattr(incremental, "_publish_tested", overtaken)
    merge_file(spark, cfg, "c", rows[16:])
    assert len(calls) == 3  # overtaken, the other one, again
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(golden_bronze))
    assert_kept(spark, cfg)


def test_rebuild_overtaken_by_a_merge_raises(spark, golden_bronze, tmp_root, monkeypatch):
    from snapflow.plans import pipeline

    cfg = PipelineConfig(root=tmp_root)
    rows = [tuple(r) for r in golden_bronze.collect()]
    spark.createDataFrame(rows[:20], BRONZE).coalesce(1).write.partitionBy("date").parquet(cfg.bronze_path)
    real = pipeline.gate_silver

    def gate(built):
        merge_file(spark, cfg, "b", rows[20:])
        return real(built)

    merge_file(spark, cfg, "a", rows[:20])
    monkeypatch.setattr(pipeline, "gate_silver", gate)
    with pytest.raises(PublishConflict):
        refresh_silver(spark, cfg)
    assert read_silver(spark, cfg.silver_path).count() == build_silver(golden_bronze).count()
    assert POSITIONS in manifest(spark, cfg.silver_path)["parts"]


def test_day_rewritten_while_its_rows_are_worked_out(spark, golden_bronze, tmp_root, monkeypatch):
    """The kept rows are not published for a day that has changed under them."""
    from snapflow.plans import latest

    cfg = PipelineConfig(root=tmp_root)
    publish(spark, stage(build_of(spark, golden_bronze.limit(12)), cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    real = latest.staged_newest

    def slow(*args):
        out = real(*args)
        whole = stage(build_of(spark, golden_bronze), cfg.staging_path, "date")
        publish(spark, whole, cfg.silver_path, partitioned=True)
        return out

    monkeypatch.setattr(latest, "staged_newest", slow)
    keep_newest(spark, cfg, AS_OF)
    assert kept_newest(spark, cfg.silver_path, AS_OF) is None
    want = newest_of_days(read_stored_silver(spark, cfg.silver_path).where("date = DATE'2024-05-02'"))
    assert rows_of(read_newest(spark, cfg, AS_OF)) == rows_of(want)


def build_of(spark, bronze):
    return build_silver(bronze).selectExpr("*", "'f' AS __source", "0L AS __row")
