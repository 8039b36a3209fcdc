"""Run status: newest run, durations, step map with last-wins, no runs."""

from snapflow.plans.runlog import compact_run_log, read_run_log, run_status, run_step_status, split_run_log
from snapflow.schemas import RUN_LOG


def log(spark, rows):
    return split_run_log(spark.createDataFrame(rows, RUN_LOG))


def test_no_runs(spark):
    runs, steps = log(spark, [])
    (r,) = run_status(runs, steps, "job").collect()
    assert r.status == "no_runs" and r.assets == {} and r.duration_seconds is None


def test_newest_run_and_steps(spark):
    rows = [
        ("r1", "job", "SUCCESS", 100.0, 160.0, [("bronze_1", "SUCCESS", 100.0, 110.0)]),
        ("r2", "job", "STARTED", 200.0, None, [
            ("bronze_1", "SUCCESS", 200.0, 212.34),
            ("silver_1", "FAILURE", 212.5, 230.0),
            ("silver_1", "SUCCESS", 231.0, 240.05),
            ("gold_1", "STARTED", 240.0, None),
        ]),
        ("x9", "other", "SUCCESS", 999.0, 1000.0, []),
    ]
    runs, steps = log(spark, rows)
    (r,) = run_status(runs, steps, "job").collect()
    assert (r.run_id, r.status, r.started_at, r.ended_at, r.duration_seconds) == ("r2", "STARTED", 200.0, None, None)
    assets = {k: (v.status, v.duration_seconds) for k, v in r.assets.items()}
    assert assets == {
        "bronze": ("SUCCESS", round(212.34 - 200.0, 1)),
        "silver": ("SUCCESS", round(240.05 - 231.0, 1)),
        "gold": ("STARTED", None),
    }
    flat = {(x.asset, x.asset_status) for x in run_step_status(runs, steps, "job").collect()}
    assert flat == {("bronze", "SUCCESS"), ("silver", "SUCCESS"), ("gold", "STARTED")}


def test_suffix_removed_everywhere(spark):
    rows = [("r", "job", "SUCCESS", 1.0, 2.0, [("a_1_b_1", "SUCCESS", 1.0, 2.0)])]
    runs, steps = log(spark, rows)
    (r,) = run_status(runs, steps, "job").collect()
    assert list(r.assets) == ["a_b"]


def test_run_log_partitioned_by_day_and_compacted(spark, tmp_root):
    import datetime as dt
    import os

    from snapflow.config import PipelineConfig
    from snapflow.plans.runlog import RunRecorder

    cfg = PipelineConfig(root=tmp_root)
    for start in (1714600000.0, 1714600600.0, 1714700000.0):  # two runs on 2024-05-01, one on 05-03
        rec = RunRecorder(cfg.job)
        rec.start_time = start
        with rec.step("silver"):
            pass
        rec.finish(spark, cfg, "SUCCESS")
    day1 = os.path.join(cfg.runlog_path, "day=2024-05-01")
    assert len([f for f in os.listdir(day1) if f.endswith(".parquet")]) == 2
    assert read_run_log(spark, cfg, since=dt.date(2024, 5, 2)).count() == 1
    assert compact_run_log(spark, cfg, before=dt.date(2024, 5, 2)) == 1
    assert len([f for f in os.listdir(day1) if f.endswith(".parquet")]) == 1
    assert compact_run_log(spark, cfg, before=dt.date(2024, 5, 4)) == 0  # nothing left with several files
    runs, steps = split_run_log(read_run_log(spark, cfg))
    assert runs.count() == 3
    (r,) = run_status(runs, steps, cfg.job).collect()
    assert r.started_at == 1714700000.0 and set(r.assets) == {"silver"}
