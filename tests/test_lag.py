"""with_lag: plain and hot-key-sliced forms against a brute-force model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapflow.operators.lag import heavy_keys, hot_keys, key_sketches, ranges, with_lag

SCHEMA = "k string, t timestamp_ntz, tb long, v long"


def brute_lag(rows):
    """LAG(v), LAG(t) per k ordered by (t, tb) ascending, NULLs last (Python model)."""
    def key(r):
        return (r[1] is None, r[1] or dt.datetime.min, r[2] is None, r[2] if r[2] is not None else 0)

    out = {}
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for g in groups.values():
        g.sort(key=key)
        prev = None
        for r in g:
            out[(r[0], r[2])] = (prev[3], prev[1]) if prev else (None, None)
            prev = r
    return out


def make_rows(seed, n=600):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # a third of all rows on one key, the rest over many keys, some NULL keys
        r = rnd.random()
        k = "hot" if r < 0.34 else (None if r < 0.38 else f"k{rnd.randrange(40)}")
        t = None if rnd.random() < 0.03 else base + dt.timedelta(seconds=rnd.randrange(0, 86400 * 3))
        if rnd.random() < 0.05 and rows:
            t = rows[-1][1]  # time ties
        v = None if rnd.random() < 0.05 else rnd.randrange(-50, 50)
        rows.append((k, t, i, v))
    return rows


@pytest.mark.parametrize("seed,rows_per_slice", [(1, None), (2, 7), (3, 25), (4, 1), (5, 100)])
def test_lag_matches_brute_force(spark, seed, rows_per_slice):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_lag(df, ["k"], ["t", "tb"], ["v", "t"], rows_per_slice=rows_per_slice)
    result = {(r.k, r.tb): (r.prev_v, r.prev_t) for r in got.collect()}
    assert result == brute_lag(rows)
    assert got.count() == len(rows)


def test_hot_keys_bounded(spark):
    rows = make_rows(9, 900)
    df = spark.createDataFrame(rows, SCHEMA)
    hot = hot_keys(df, ["k"], 100).collect()
    # only the key with a third of the rows exceeds 100 rows
    assert [r["__k"]["k"] for r in hot] == ["hot"]


def test_sliced_plan_partitions_on_slice(spark):
    df = spark.createDataFrame(make_rows(11), SCHEMA)
    plan = with_lag(df, ["k"], ["t", "tb"], ["v"], rows_per_slice=20)._jdf.queryExecution().executedPlan().toString()
    assert "__s" in plan and "Window" in plan


def test_hot_key_spread_over_tasks(spark):
    """The hot key's rows land in many shuffle partitions once sliced."""
    df = spark.createDataFrame(make_rows(12, 1200), SCHEMA)
    out = with_lag(df, ["k"], ["t", "tb"], ["v"], rows_per_slice=30)
    parts = out.where(F.col("k") == "hot").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_slices_stay_even_on_uneven_times(spark):
    """One outlier time, many equal times and many NULL times: no range above twice its share."""
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(seconds=i), i, i) for i in range(6000)]
    rows += [("hot", dt.datetime(2014, 1, 1), 6000, 0)]
    rows += [("hot", base, 7000 + i, i) for i in range(3000)] + [("hot", None, 10_000 + i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = ranges(df, ["k"], ["t", "tb"], len(rows), 1000)
    sizes = [r["count"] for r in parts.groupBy("__s").count().collect()]
    assert max(sizes) <= 2 * len(rows) / 8 and len(sizes) <= 8
    got = with_lag(df, ["k"], ["t", "tb"], ["v", "t"], rows_per_slice=1000)
    assert {(r.k, r.tb): (r.prev_v, r.prev_t) for r in got.collect()} == brute_lag(rows)


def test_full_ties_are_ordered_alike_in_both_forms(spark):
    rows = [("hot", dt.datetime(2024, 1, 1), 1, i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    forms = [with_lag(df, ["k"], ["t", "tb"], ["v"], rows_per_slice=n) for n in (None, 20)]
    a, b = ([tuple(r) for r in f.collect()] for f in forms)
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_no_cached_tables_stay_behind(spark):
    with_lag(spark.createDataFrame(make_rows(5), SCHEMA), ["k"], ["t", "tb"], ["v"], rows_per_slice=20).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_never_more_ranges_than_shuffle_partitions(spark):
    """A tiny slice size asks for thousands of slices; they share the session's partitions."""
    rows = [(f"k{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = ranges(df, ["k"], ["t", "tb"], len(rows), 1)
    assert len(parts.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = with_lag(df, ["k"], ["t", "tb"], ["v", "t"], rows_per_slice=1)
    assert {(r.k, r.tb): (r.prev_v, r.prev_t) for r in got.collect()} == brute_lag(rows)


def test_kept_statistic_in_place_of_the_count(spark):
    """Sketches per day, merged, name the hot keys; a wrong statistic changes no value."""
    rows = make_rows(21, 900)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("day", F.to_date("t"))
    sketches = key_sketches(df, "k", ["day"])
    assert sketches.count() == 4  # three days and the rows without a time
    heavy = heavy_keys(sketches, "k")
    assert {r["k"]: r["__n"] for r in heavy.where("__n > 100").collect()} == {"hot": sum(r[0] == "hot" for r in rows)}
    wrong = spark.createDataFrame([("k1", 10**9), ("nobody", 10**9)], "k string, __n long")
    for hot in (heavy, wrong, heavy.limit(0)):
        got = with_lag(df.drop("day"), ["k"], ["t", "tb"], ["v", "t"], rows_per_slice=100, hot=hot)
        assert {(r.k, r.tb): (r.prev_v, r.prev_t) for r in got.collect()} == brute_lag(rows)
