"""Incremental silver equals the full rebuild, whatever order the files arrive in."""

import datetime as dt
import os
import random
import shutil
import time

import pytest

from pyspark.sql import functions as F

from snapflow.config import PipelineConfig
from snapflow.plans import gold
from snapflow.plans.pipeline import read_gold, read_gold_ordered, refresh_gold, refresh_silver
from snapflow.plans.silver import build_silver, clean, position
from snapflow.schemas import BRONZE, POSITIONS, SOURCE_COLUMNS
from snapflow.sources.lake import read_silver, read_stored_silver
from snapflow.sources.sinks import append_snapshot
from snapflow.sources.tables import read_side
from snapflow.streaming.incremental import merge_batch, neighbours, positions_of, start_incremental

D, H, DAY = dt.datetime, dt.timedelta(hours=1), dt.timedelta(days=1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def merge_file(spark, cfg, name, rows, gate=True):
    """Merge rows as one bronze file of that name."""
    at = "date=x/" + name
    batch = spark.createDataFrame(rows, BRONZE).coalesce(1).withColumns({"__source": F.lit(at), "__row": F.monotonically_increasing_id()})
    return merge_batch(spark, cfg, batch, gate=gate)


def stored_files_read(spark, cfg, batch):
    """The silver files a merge of ``batch`` looks at to find neighbours."""
    positions = read_side(spark, cfg.silver_path, POSITIONS)
    added = clean(spark.createDataFrame(batch, BRONZE).withColumns({"__source": F.lit("n"), "__row": F.lit(0).cast("long")}), SOURCE_COLUMNS).withColumn("__pos", position())
    rows, _, folders = neighbours(spark, cfg, added, positions)
    found = rows.count()
    silver = [f for f in rows.inputFiles() if "/silver/date=" in f]
    assert not silver  # what was read is staged
    return found, bool(folders)


def land_files(spark, bronze, cfg, groups):
    """Write each group of rows as one bronze file, in the given order (mtime order)."""
    for g in groups:
        part = spark.createDataFrame(g, BRONZE)
        part.coalesce(1).write.mode("append").partitionBy("date").parquet(cfg.bronze_path)
        time.sleep(0.05)


def test_stream_equals_batch_with_late_file(spark, golden_bronze, tmp_root):
    rows = [tuple(r) for r in golden_bronze.collect()]
    rnd = random.Random(4)
    rnd.shuffle(rows)
    # five files; the file holding the 05-01 rows arrives last (late data)
    early = [r for r in rows if str(r[-1]) == "2024-05-02"]
    late = [r for r in rows if str(r[-1]) != "2024-05-02"]
    groups = [early[i::4] for i in range(4)] + [late]
    cfg = PipelineConfig(root=tmp_root)
    land_files(spark, golden_bronze, cfg, groups)
    start_incremental(spark, cfg, files_per_trigger=1)
    got = read_silver(spark, cfg.silver_path)
    assert rows_of(got) == rows_of(build_silver(golden_bronze))


def test_replayed_file_is_a_noop(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    rows = [tuple(r) for r in golden_bronze.collect()]
    merge_file(spark, cfg, "a", rows[:10])
    merge_file(spark, cfg, "b", rows[10:])
    first = rows_of(read_silver(spark, cfg.silver_path))
    assert merge_file(spark, cfg, "a", rows[:10]) == []
    assert rows_of(read_silver(spark, cfg.silver_path)) == first


def test_lost_checkpoint_merges_nothing_twice(spark, golden_bronze, tmp_root):
    """A stream that starts over reads every file again; so does one after a rebuild."""
    rows = [tuple(r) for r in golden_bronze.collect()]
    cfg = PipelineConfig(root=tmp_root)
    land_files(spark, golden_bronze, cfg, [rows[:12], rows[12:]])
    want = rows_of(build_silver(golden_bronze))
    refresh_silver(spark, cfg)
    start_incremental(spark, cfg, files_per_trigger=2)  # new checkpoint, all files known
    assert rows_of(read_silver(spark, cfg.silver_path)) == want
    shutil.move(cfg.stream_checkpoint_path, os.path.join(tmp_root, "lost"))
    start_incremental(spark, cfg)
    assert rows_of(read_silver(spark, cfg.silver_path)) == want


def test_restart_resumes_from_checkpoint(spark, golden_bronze, tmp_root):
    rows = [tuple(r) for r in golden_bronze.collect()]
    cfg = PipelineConfig(root=tmp_root)
    land_files(spark, golden_bronze, cfg, [rows[:12]])
    start_incremental(spark, cfg)
    land_files(spark, golden_bronze, cfg, [rows[12:]])
    start_incremental(spark, cfg)  # a new query run picks up only the new file
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(golden_bronze))
    assert os.path.isdir(cfg.stream_checkpoint_path)


@pytest.mark.parametrize("seed", [11, 12])
def test_random_splits_equal_rebuild(spark, golden_bronze, tmp_root, seed):
    """Any split of bronze into batches, in any arrival order, with a replayed
    batch, yields the batch silver (seeded property test)."""
    rows = [tuple(r) for r in golden_bronze.collect()]
    rnd = random.Random(seed)
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(1, len(rows)), 2))
    chunks = [rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]]
    names = ["a", "b", "c"]
    again = rnd.randrange(2)  # a replay of an earlier file
    chunks.insert(2, chunks[again]), names.insert(2, names[again])
    cfg = PipelineConfig(root=tmp_root)
    for name, chunk in zip(names, chunks):
        merge_file(spark, cfg, name, chunk)
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(golden_bronze))


def station(code, due, bikes, ingested, name=None):
    text = due.strftime("%Y-%m-%dT%H:%M:%S") if due else None
    return (code, name or code, "Paris", "75056", bikes, bikes, 0, 20 - bikes, 20, "OUI", "OUI", "OUI", 1.0, 2.0, text, ingested, ingested.date())


def test_repeated_records_all_stay_in_both_paths(spark, tmp_root):
    """Equal records of one poll, or of two files, are as many silver rows, in a rebuild and in a merge."""
    t = D(2024, 5, 2, 8)
    rows = [station("A", t, 5, t), station("A", t, 5, t), station("A", t, 9, t), station("A", t + H, 7, t + H), station("A", t - H, 4, t)]
    rows += [station("A", t + H, 7, t + H), station("A", t, 5, t)]
    full = build_silver(spark.createDataFrame(rows, BRONZE))
    assert full.count() == len(rows)
    cfg = PipelineConfig(root=tmp_root)
    for name, chunk in zip("abcde", (rows[:2], rows[2:4], rows[4:5], rows[5:6], rows[6:])):
        merge_file(spark, cfg, name, chunk)
        merge_file(spark, cfg, name, chunk)
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(full)


def test_row_before_two_equal_rows_keeps_both(spark, tmp_root):
    """One of two rows equal in every silver column changes; the other stays."""
    t = D(2024, 5, 2, 8)
    rows = [station("A", t, 5, t - H), station("A", t, 5, t), station("A", t, 5, t)]
    late = station("A", t, 8, t - H / 2)
    cfg = PipelineConfig(root=tmp_root)
    merge_file(spark, cfg, "a", rows)
    merge_file(spark, cfg, "b", [late])
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(spark.createDataFrame([*rows, late], BRONZE)))


def test_late_row_rewrites_two_days_at_most(spark, tmp_root):
    start = D(2024, 5, 1, 12)
    rows = [station(c, start + k * DAY, 10 - k % 3, start + k * DAY) for k in range(20) for c in ("A", "B")]
    cfg = PipelineConfig(root=tmp_root)
    merge_batch(spark, cfg, spark.createDataFrame(rows, BRONZE))
    late = station("A", start + H, 3, start + 20 * DAY)  # reported on day 1, delivered on day 21
    dates = merge_batch(spark, cfg, spark.createDataFrame([late], BRONZE))
    assert len(dates) <= 2
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(spark.createDataFrame([*rows, late], BRONZE)))


@pytest.mark.parametrize("days", [6, 18])
def test_odd_clocks_read_no_stored_files(spark, tmp_root, days):
    """One station 75 years ahead, one stuck in 2018, one silent for long, one new: whatever the
    length of the history, their next reports look at no silver file."""
    start, old = D(2024, 5, 1, 12), D(2018, 1, 1)
    codes = [f"s{i}" for i in range(6)]
    rows = [station(c, start + k * DAY, 9, start + k * DAY) for k in range(days) for c in codes]
    rows += [station("stuck", old, 4 + k % 2, start + k * DAY) for k in range(days)]
    rows += [station("fast", (start + k * DAY).replace(year=2099 if k % 3 == 1 else 2024), 3 + k % 4, start + k * DAY) for k in range(days)]
    rows += [station("silent", start, 2, start)]
    cfg = PipelineConfig(root=tmp_root)
    merge_batch(spark, cfg, spark.createDataFrame(rows, BRONZE))
    every = list(rows)
    for turn in range(3):
        now = start + days * DAY + turn * H
        batch = [station(c, now, 8 - turn, now) for c in codes]
        batch += [station("stuck", old, 6 + turn, now), station("fast", now, 5 + turn, now), station("silent", now, 4, now), station(f"new{turn}", now, 1, now)]
        found, read = stored_files_read(spark, cfg, batch)
        if turn:  # on the first the clock of "fast" may just have jumped back
            assert not read
        merge_file(spark, cfg, f"t{turn}", batch)
        every += batch
        assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(spark.createDataFrame(every, BRONZE)))
        assert found <= 2 * (len(codes) + 4) or not turn
    held = read_side(spark, cfg.silver_path, POSITIONS)
    assert held.count() == len(codes) + 6
    assert rows_of(held) == rows_of(positions_of(read_stored_silver(spark, cfg.silver_path)))


def test_position_table_follows_late_files(spark, tmp_root):
    """Random report times, late files and repeats: the kept table equals one made from scratch."""
    rnd = random.Random(6)
    cfg = PipelineConfig(root=tmp_root)
    every = []
    for turn in range(5):
        now = D(2024, 5, 1, 12) + turn * H
        batch = [
            station(c, None if rnd.random() < 0.1 else now + rnd.choice([0, 0, -3, 3, -9]) * H, rnd.randrange(9), now - rnd.choice([0, 0, 5]) * H)
            for c in "ABCD" for _ in range(rnd.randint(0, 2))
        ]
        batch += rnd.sample(every, min(2, len(every)))
        every += batch
        if batch:
            merge_file(spark, cfg, f"t{turn}", batch, gate=False)  # NULL report times
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(spark.createDataFrame(every, BRONZE)))
    columns = ["station_code", *[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in ("cur", "next") for c in ("last_reported", "ingested_at", "bikes_available")]]
    held = read_side(spark, cfg.silver_path, POSITIONS).select(*columns)
    assert rows_of(held) == rows_of(positions_of(read_stored_silver(spark, cfg.silver_path)).select(*columns))


def test_backlog_is_drained_in_capped_batches(spark, golden_bronze, tmp_root):
    rows = [tuple(r) for r in golden_bronze.collect()]
    cfg = PipelineConfig(root=tmp_root)
    land_files(spark, golden_bronze, cfg, [rows[i::5] for i in range(5)])
    query = start_incremental(spark, cfg, files_per_trigger=2)
    files = sum(len([x for x in f if x.endswith(".parquet")]) for _, _, f in os.walk(cfg.bronze_path))
    batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    assert len(set(batches)) >= files // 2
    assert rows_of(read_silver(spark, cfg.silver_path)) == rows_of(build_silver(golden_bronze))


def test_expired_bronze_leaves_silver_unchanged(spark, tmp_root):
    """Three days stored, two expired, rebuilt: every kept value is as before."""
    start = D(2024, 5, 1, 12)
    rows = [station(c, start + k * DAY, 11 - 3 * k, start + k * DAY) for k in range(3) for c in ("A", "B")]
    rows.append(station("A", start + 2 * DAY, 1, start + 2 * DAY + H))  # a tie in the report time
    cfg = PipelineConfig(root=tmp_root)
    append_snapshot(spark.createDataFrame(rows, BRONZE), cfg.bronze_path)
    refresh_silver(spark, cfg)
    before = rows_of(read_silver(spark, cfg.silver_path))
    for day in ("2024-05-01", "2024-05-02"):
        shutil.rmtree(os.path.join(cfg.bronze_path, f"date={day}"))
    refresh_silver(spark, cfg)
    assert rows_of(read_silver(spark, cfg.silver_path)) == before


def test_thresholds_of_the_configuration_reach_gold(spark, golden_bronze, tmp_root):
    for minutes, empty in ((1e6, 10**6), (0, 0)):
        cfg = PipelineConfig(root=os.path.join(tmp_root, str(empty)), risk_minutes=minutes, empty_minutes=empty)
        append_snapshot(golden_bronze, cfg.bronze_path)
        refresh_silver(spark, cfg)
        refresh_gold(spark, cfg, dt.date(2024, 5, 2))
        silver = read_silver(spark, cfg.silver_path)
        for name, want in (
            ("stations_at_risk", gold.stations_at_risk(silver, dt.date(2024, 5, 2), minutes)),
            ("stations_empty_duration", gold.stations_empty_duration(silver, dt.date(2024, 5, 2), empty)),
        ):
            assert rows_of(read_gold(spark, cfg, name)) == rows_of(want)
    assert read_gold_ordered(spark, cfg, "district_stats").first()["arrondissement"] == "Issy"
