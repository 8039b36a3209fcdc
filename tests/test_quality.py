"""Each data test fires on one violating row, with its severity; the gate stops on errors."""

import datetime as dt

import pytest

from snapflow.operators.quality import QualityGateError
from snapflow.plans.quality import SILVER_CHECKS, gate_silver, silver_quality_report, silver_violations
from snapflow.plans.silver import build_silver
from snapflow.schemas import SILVER

GOOD = dict(
    station_code="A", station_name="a", arrondissement="Paris", code_insee="75056", bikes_available=3,
    bikes_mechanical=2, bikes_electric=1, docks_available=7, capacity=10, is_installed=True, is_renting=True,
    is_returning=True, latitude=48.85, longitude=2.35, last_reported=dt.datetime(2024, 5, 2, 8, 0),
    ingested_at=dt.datetime(2024, 5, 2, 8, 5), date=dt.date(2024, 5, 2), prev_bikes_available=4,
    bikes_delta=-1, minutes_since_last_snapshot=10, depletion_rate_per_minute=-0.1,
)

# One violating row per check (value overrides on a good row).
BREAKERS = {
    "not_null__station_code": dict(station_code=None),
    "not_null__station_name": dict(station_name=None),
    "not_null__bikes_available": dict(bikes_available=None),
    "range__bikes_available": dict(bikes_available=-1),
    "not_null__capacity": dict(capacity=None),
    "range__capacity": dict(capacity=0),
    "not_null__last_reported": dict(last_reported=None),
    "not_null__is_renting": dict(is_renting=None),
    "not_null__is_returning": dict(is_returning=None),
    "range__depletion_rate_per_minute": dict(depletion_rate_per_minute=-51.0, capacity=100),
    "range__bikes_delta": dict(bikes_delta=101),
    "bikes_not_negative": dict(bikes_available=-2),
    "capacity_positive": dict(capacity=-3),
    "rate_within_capacity": dict(depletion_rate_per_minute=-12.0),
}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in SILVER.fieldNames()) for r in rows], SILVER)


def report(spark, rows):
    return {r.check_name: (r.failures, r.severity, r.status) for r in silver_quality_report(frame(spark, rows)).collect()}


def test_sixteen_checks():
    assert len(SILVER_CHECKS) == 16
    assert sum(c.severity == "warn" for c in SILVER_CHECKS) == 3


def test_clean_frame_passes(spark):
    rep = report(spark, [GOOD, GOOD])
    assert all(f == 0 and s == "pass" for f, _, s in rep.values())


@pytest.mark.parametrize("name", sorted(BREAKERS))
def test_each_check_fires(spark, name):
    bad = dict(GOOD, **BREAKERS[name])
    rep = report(spark, [GOOD, bad])
    failures, severity, status = rep[name]
    assert failures >= 1
    assert status == ("warn" if severity == "warn" else "fail")


def test_accepted_values_counts_distinct_values_and_null_passes(spark):
    rep = report(spark, [GOOD, dict(GOOD, is_renting=None)])
    assert rep["values__is_renting"][0] == 0  # NULL passes accepted_values (not_null catches it)
    assert rep["not_null__is_renting"][0] == 1


def test_gate(spark):
    gate_silver(frame(spark, [GOOD]))
    with pytest.raises(QualityGateError):
        gate_silver(frame(spark, [GOOD, dict(GOOD, station_code=None)]))
    # warnings alone do not stop
    gate_silver(frame(spark, [GOOD, dict(GOOD, bikes_delta=500)]))


def test_violations_rows(spark):
    v = silver_violations(frame(spark, [GOOD, dict(GOOD, bikes_available=-1)])).collect()
    assert {r.check_name for r in v} == {"range__bikes_available", "bikes_not_negative"}


def test_null_report_time_sorts_last_and_fails_not_null(spark, golden_bronze):
    from snapflow.schemas import BRONZE

    rows = [tuple(r) for r in golden_bronze.collect()]
    idx = BRONZE.fieldNames().index("duedate")
    late = list(rows[1])
    late[idx] = None
    silver = build_silver(spark.createDataFrame(rows + [tuple(late)], BRONZE))
    (r,) = silver.where("station_code = 'A' AND last_reported IS NULL").collect()
    assert r.prev_bikes_available == 4  # after A's last timed row
    with pytest.raises(QualityGateError):
        gate_silver(silver)


def test_accepted_values_on_text_counts_distinct_bad_values(spark):
    from snapflow.operators.quality import Check, run_checks

    df = spark.createDataFrame([("a",), ("b",), ("b",), ("z",), (None,)], "v string")
    (r,) = run_checks(df, [Check("values__v", "accepted_values", "v", values=("a",))]).collect()
    assert r.failures == 2 and r.status == "fail"  # distinct bad values b, z; NULL passes
