"""Physical-plan properties the design relies on, and the driver contract."""

import duckdb
from conftest import AS_OF

import __spark_entry__ as entry
from snapflow.config import PipelineConfig
from snapflow.operators.latest import latest_per_key
from snapflow.plans import gold
from snapflow.plans.catalog import QUERIES
from snapflow.plans.feeds import events_as_bronze
from snapflow.plans.oracle_sql import SQL
from snapflow.plans.silver import build_silver
from snapflow.schemas import BRONZE
from snapflow.sources.lake import read_silver
from snapflow.sources.sinks import stage
from snapflow.sources.tables import publish

SMOKE = "/root/testdata/sf0.001"


def plan_text(df):
    """The plan that ran, after adaptive re-planning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def test_silver_is_one_exchange_one_window(spark, golden_bronze):
    text = build_silver(golden_bronze)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 1  # both LAGs share one Window node


def test_latest_per_key_limits_before_shuffle(spark, golden_bronze):
    df = latest_per_key(golden_bronze, ["stationcode"], [golden_bronze.duedate.desc()])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_stored_silver_is_pruned_by_date(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    publish(spark, stage(build_silver(golden_bronze), cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    df = gold.district_stats(read_silver(spark, cfg.silver_path), AS_OF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "2024-05-02" in text
    assert {r.arrondissement for r in df.collect()} == {"Issy", "Paris", None}


def test_empty_duration_is_one_pass(spark, golden_bronze, tmp_root):
    cfg = PipelineConfig(root=tmp_root)
    publish(spark, stage(build_silver(golden_bronze), cfg.staging_path, "date"), cfg.silver_path, partitioned=True)
    text = plan_text(gold.stations_empty_duration(read_silver(spark, cfg.silver_path), AS_OF))
    assert "isFinalPlan=true" in text
    final = text.split("+- == Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(station_code") == 1
    assert "Join" not in final and final.count("Scan parquet") <= 1


def test_gold_is_not_built_in_one_task(spark, golden_bronze):
    text = gold.stations_at_risk(build_silver(golden_bronze), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in text and "SinglePartition" not in text


def test_reports_without_lag_plan_no_job_and_no_window(spark):
    from snapflow.plans.catalog import QUERIES

    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    df = QUERIES["district_stats"](spark, SMOKE)
    assert store.executionsCount() == before
    assert "lag(" not in df._jdf.queryExecution().executedPlan().toString()


def test_events_feed_has_bronze_schema(spark):
    df = events_as_bronze(spark.read.parquet(f"{SMOKE}/events.parquet"))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in BRONZE.fields]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["arrondissement", "total_stations"]


def test_every_query_has_sql(spark):
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) == set(QUERIES) <= set(entry.oracle_sql())


def test_sample_queries_agree_with_their_sql(spark):
    con = duckdb.connect()
    for t in ("events", "orders", "customer", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ("silver", "quality_report", "run_step_status", "latest_order_stats", "run_status", "district_list"):
        got = entry.queries()[name](spark, SMOKE)
        cur = con.execute(SQL[name])
        names = [d[0] for d in cur.description]
        want = sorted((repr(tuple(r[names.index(c)] for c in got.columns)) for r in cur.fetchall()))
        rows = sorted(repr(tuple(r)) for r in got.collect())
        assert rows == want and rows, name
