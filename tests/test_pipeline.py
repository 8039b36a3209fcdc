"""End to end: landed JSON -> bronze -> silver (tested) -> gold -> insights -> run log."""

import datetime as dt
import json
import os

import pytest

from snapflow.config import PipelineConfig
from snapflow.operators.quality import QualityGateError
from snapflow.plans.pipeline import export_insights, read_gold, run_pipeline, serve_insights
from snapflow.plans.runlog import read_run_log, run_status, split_run_log
from snapflow.sources.lake import list_files, read_silver
from snapflow.sources.sinks import append_snapshot


def land(tmp_root, name, records):
    path = os.path.join(tmp_root, "landing", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(records, f)
    return path


def record(code, bikes, due, cap=10, renting="OUI"):
    return {
        "stationcode": code, "name": code.lower(), "nom_arrondissement_communes": "Paris",
        "code_insee_commune": "75056", "numbikesavailable": bikes, "mechanical": bikes, "ebike": 0,
        "numdocksavailable": cap - bikes, "capacity": cap, "is_installed": "OUI", "is_renting": renting,
        "is_returning": "OUI", "coordonnees_geo": {"lat": 48.85, "lon": 2.35}, "duedate": due,
    }


def test_two_ticks_end_to_end(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=os.path.join(tmp_root, "lake"))
    append_snapshot(golden_bronze, cfg.bronze_path)
    as_of = dt.date(2024, 5, 2)
    p1 = land(tmp_root, "t1.json", [record("Z", 9, "2024-05-02T08:30:00+00:00")])
    p2 = land(tmp_root, "t2.json", [record("Z", 3, "2024-05-02T08:40:00+00:00")])
    run_pipeline(spark, cfg, as_of, p1, dt.datetime(2024, 5, 2, 8, 35))
    run_pipeline(spark, cfg, as_of, p2, dt.datetime(2024, 5, 2, 8, 45))

    silver = read_silver(spark, cfg.silver_path)
    (z,) = silver.where("station_code = 'Z' AND bikes_available = 3").collect()
    assert (z.bikes_delta, z.minutes_since_last_snapshot, z.depletion_rate_per_minute) == (-6, 10, -0.6)

    risk = {r.station_code for r in read_gold(spark, cfg, "stations_at_risk").collect()}
    assert risk == {"A", "B", "Z"}
    stats = {r.arrondissement: r.total_stations for r in read_gold(spark, cfg, "district_stats").collect()}
    assert stats["Paris"] == 4

    out = serve_insights(spark, cfg, as_of)
    (m,) = out["snapshot_metrics"].collect()
    assert m.stations_per_snapshot == 1  # the newest ingest holds only Z
    assert m.bronze_snapshots_today == len(
        [r for r in list_files(spark, cfg.bronze_path).collect() if "date=2024-05-02/" in r.path]
    )
    assert out["at_risk"].count() == 3

    runs, steps = split_run_log(read_run_log(spark, cfg))
    (st,) = run_status(runs, steps, cfg.job).collect()
    assert st.status == "SUCCESS" and set(st.assets) == {"bronze", "silver", "gold"}

    paths = export_insights(spark, cfg, as_of, os.path.join(tmp_root, "api"))
    summary = spark.read.json(next(p for p in paths if p.endswith("summary"))).first()
    assert summary.total_stations == 10 and summary.pct_electric is not None


def test_gate_keeps_previous_tables(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=os.path.join(tmp_root, "lake"))
    append_snapshot(golden_bronze, cfg.bronze_path)
    as_of = dt.date(2024, 5, 2)
    run_pipeline(spark, cfg, as_of)
    before = read_silver(spark, cfg.silver_path).count()
    bad = land(tmp_root, "bad.json", [record("Q", -4, "2024-05-02T09:00:00+00:00")])
    with pytest.raises(QualityGateError):
        run_pipeline(spark, cfg, as_of, bad, dt.datetime(2024, 5, 2, 9, 5))
    assert read_silver(spark, cfg.silver_path).count() == before
    runs, steps = split_run_log(read_run_log(spark, cfg))
    (st,) = run_status(runs, steps, cfg.job).collect()
    assert st.status == "FAILURE" and st.assets["silver"].status == "FAILURE"


def test_incremental_ticks_match_rebuild(spark, golden_bronze, tmp_root):
    from snapflow.plans.silver import build_silver

    cfg = PipelineConfig(root=os.path.join(tmp_root, "lake"))
    append_snapshot(golden_bronze, cfg.bronze_path)
    as_of = dt.date(2024, 5, 2)
    run_pipeline(spark, cfg, as_of, incremental=True)
    p1 = land(tmp_root, "t1.json", [record("Z", 9, "2024-05-02T08:30:00+00:00")])
    run_pipeline(spark, cfg, as_of, p1, dt.datetime(2024, 5, 2, 8, 35), incremental=True)
    got = sorted(map(tuple, read_silver(spark, cfg.silver_path).collect()), key=repr)
    from snapflow.sources.lake import read_bronze

    want = sorted(map(tuple, build_silver(read_bronze(spark, cfg.bronze_path)).collect()), key=repr)
    assert got == want
    assert {r.station_code for r in read_gold(spark, cfg, "stations_at_risk").collect()} == {"A", "B"}


def test_incremental_gate_stops_the_stream(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=os.path.join(tmp_root, "lake"))
    append_snapshot(golden_bronze, cfg.bronze_path)
    as_of = dt.date(2024, 5, 2)
    run_pipeline(spark, cfg, as_of, incremental=True)
    before = read_silver(spark, cfg.silver_path).count()
    bad = land(tmp_root, "bad.json", [record("Q", -4, "2024-05-02T09:00:00+00:00")])
    with pytest.raises(Exception):
        run_pipeline(spark, cfg, as_of, bad, dt.datetime(2024, 5, 2, 9, 5), incremental=True)
    assert read_silver(spark, cfg.silver_path).count() == before


def test_command_line(spark, golden_bronze, tmp_root, capsys):
    from snapflow.__main__ import main

    root = os.path.join(tmp_root, "lake")
    append_snapshot(golden_bronze, PipelineConfig(root=root).bronze_path)
    p1 = land(tmp_root, "t1.json", [record("Z", 9, "2024-05-02T08:30:00+00:00")])
    assert main(["tick", "--root", root, "--landed", p1, "--as-of", "2024-05-02"], spark=spark) == 0
    assert main(["insights", "--root", root, "--as-of", "2024-05-02", "--out", os.path.join(tmp_root, "api")], spark=spark) == 0
    assert main(["status", "--root", root], spark=spark) == 0
    assert main(["cleanup", "--root", root, "--now", "2024-05-02T02:00:00"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "summary" in out and "SUCCESS" in out and "bronze" in out
