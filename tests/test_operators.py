"""Generic operators on small random and edge-case inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapflow.operators.grouped import count_rows, grouped_stats, ratio_of_totals, total
from snapflow.operators.latest import latest_per_key, top_k
from snapflow.plans import gold
from snapflow.schemas import SILVER


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_latest_per_key_one_row_per_key(spark, seed):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        k = "hot" if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else f"k{rnd.randrange(30)}")
        t = None if rnd.random() < 0.05 else base + dt.timedelta(minutes=rnd.randrange(5000))
        rows.append((k, t, i))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")
    got = {r.k: (r.t, r.id) for r in latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("id").desc()]).collect()}
    want = {}
    for k, t, i in rows:
        cur = want.get(k)
        key = (t is not None, t or base, i)
        if cur is None or key > (cur[0] is not None, cur[0] or base, cur[1]):
            want[k] = (t, i)
    assert got == want


def test_top_k_orders_and_limits(spark):
    df = spark.createDataFrame([(i % 7, f"s{i:02d}") for i in range(30)], "v long, s string")
    got = [tuple(r) for r in top_k(df, 4, [F.col("v").desc(), F.col("s")]).collect()]
    assert got == [(6, "s06"), (6, "s13"), (6, "s20"), (6, "s27")]


def test_zero_capacity_group_gives_null_fill_rate(spark):
    df = spark.createDataFrame([("x", 0, 0), ("x", 0, 0), ("y", 3, 10)], "g string, b long, c long")
    out = {
        r.g: (r.n, r.b, r.pct)
        for r in grouped_stats(df, ["g"], [count_rows("n"), total("b", "b"), ratio_of_totals("b", "c", "pct")]).collect()
    }
    assert out == {"x": (2, 0, None), "y": (1, 3, 30.0)}


def test_district_stats_called_directly_on_zero_capacity(spark):
    row = dict.fromkeys(SILVER.fieldNames())
    row.update(
        station_code="Z", station_name="z", arrondissement="Nowhere", bikes_available=0, bikes_mechanical=0,
        bikes_electric=0, docks_available=0, capacity=0, last_reported=dt.datetime(2024, 5, 2, 8),
        ingested_at=dt.datetime(2024, 5, 2, 8, 5), date=dt.date(2024, 5, 2),
    )
    df = spark.createDataFrame([tuple(row[c] for c in SILVER.fieldNames())], SILVER)
    (r,) = gold.district_stats(df, dt.date(2024, 5, 2)).collect()
    assert r.total_capacity == 0 and r.fill_rate_pct is None and r.empty_stations == 1 and r.full_stations == 1
