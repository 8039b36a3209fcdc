"""The stored-path queries give all rows of a feed that the data tests reject; a pipeline stops on it."""

import datetime as dt
import os

import pytest

from snapflow.config import PipelineConfig
from snapflow.operators.quality import QualityGateError
from snapflow.plans.catalog import QUERIES, bronze
from snapflow.plans.pipeline import refresh_silver
from snapflow.sources.sinks import append_snapshot
from snapflow.sources.tables import exists

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
T = dt.datetime(2024, 1, 30, 8)


@pytest.fixture()
def sf_dir(spark, tmp_root):
    """A user whose bikes go from 200 to 0 within a minute, on the second day, and a user without such a jump."""
    steps = [(1, -1440, 800.0), (1, 0, 800.0), (1, 1, 0.0), (2, -1440, 12.0), (2, 30, 8.0)]
    rows = [(i, T + dt.timedelta(minutes=m), user, "cart", value, '{"k": 1}') for i, (user, m, value) in enumerate(steps, 1)]
    path = os.path.join(tmp_root, "sf")
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{path}/events.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["incremental_silver", "stored_silver_after_expiry"])
def test_all_rows_of_a_feed_that_fails_a_test(spark, sf_dir, name):
    want = rows_of(QUERIES["silver"](spark, sf_dir))
    assert len(want) == 5 and min(r[-1] for r in want if r[-1] is not None) == -200.0
    assert rows_of(QUERIES[name](spark, sf_dir)) == want


def test_newest_rows_and_districts_of_a_feed_that_fails_a_test(spark, sf_dir):
    newest = QUERIES["latest_stations"](spark, sf_dir).select("date", "station_code", "bikes_available")
    jan = dt.date(2024, 1, 29)
    assert rows_of(newest) == rows_of(
        spark.createDataFrame([(jan, "1", 200), (jan, "2", 3), (T.date(), "1", 0), (T.date(), "2", 2)], "d date, s string, b long")
    )
    want = rows_of(QUERIES["district_list"](spark, sf_dir).select("arrondissement", "total_stations"))
    assert rows_of(QUERIES["exported_district_list"](spark, sf_dir).select("arrondissement", "total_stations")) == want


def test_a_pipeline_stops_on_it(spark, sf_dir, tmp_root):
    cfg = PipelineConfig(root=os.path.join(tmp_root, "lake"))
    append_snapshot(bronze(spark, sf_dir), cfg.bronze_path)
    with pytest.raises(QualityGateError, match="rate_within_capacity=1"):
        refresh_silver(spark, cfg)
    assert not exists(spark, cfg.silver_path)
