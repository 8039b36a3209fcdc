"""Scalar helpers against the SQL engine the workload was written for (DuckDB)."""

import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from snapflow.functions import guarded_pct, minute_boundaries, python_datetime_text, round_half_away


def test_round_half_away_matches_duckdb(spark):
    rnd = random.Random(7)
    pairs = [(p, q) for p, q in ((rnd.randrange(-600, 600), rnd.randrange(1, 900)) for _ in range(3000))]
    pairs += [(57, 200), (-57, 200), (1, 8), (5, 2), (-5, 2)]
    df = spark.createDataFrame(pairs, "p long, q long")
    got = {
        (r.p, r.q): (r.r4, r.r1, r.r0)
        for r in df.select(
            "p", "q",
            round_half_away(F.col("p").cast("double") / F.col("q"), 4).alias("r4"),
            round_half_away(F.lit(100.0) * F.col("p") / F.col("q"), 1).alias("r1"),
            round_half_away(F.col("p").cast("double") / F.col("q"), 0).alias("r0"),
        ).collect()
    }
    con = duckdb.connect()
    con.execute("CREATE TABLE t(p BIGINT, q BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = {
        (p, q): (a, b, c)
        for p, q, a, b, c in con.execute(
            "SELECT p, q, ROUND(CAST(p AS DOUBLE) / q, 4), ROUND(100.0 * p / q, 1), ROUND(CAST(p AS DOUBLE) / q, 0) FROM t"
        ).fetchall()
    }
    assert got == want


def test_minute_boundaries_matches_duckdb(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 3, 9, 23, 0)
    pairs = []
    for _ in range(2000):
        a = base + dt.timedelta(microseconds=rnd.randrange(0, 3 * 86400 * 10**6))
        b = a + dt.timedelta(microseconds=rnd.randrange(0, 7200 * 10**6))
        pairs.append((a, b))
    pairs.append((dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0)))
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = sorted((r.a, r.b, r.m) for r in df.select("a", "b", minute_boundaries("a", "b").alias("m")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a TIMESTAMP, b TIMESTAMP)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = sorted(con.execute("SELECT a, b, DATEDIFF('minute', a, b) FROM t").fetchall())
    assert got == want
    assert (dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0), 1) in got


def test_minute_boundaries_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 2, 30))], "a timestamp_ntz, b timestamp_ntz"
        )
        (r,) = df.select(minute_boundaries("a", "b").alias("m")).collect()
        assert r.m == 31
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_guarded_pct_matches_python_round(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(0, 300), rnd.randrange(1, 600)) for _ in range(3000)] + [(0, 0), (5, None), (None, 4)]
    df = spark.createDataFrame(pairs, "e long, b long")
    got = {(r.e, r.b): r.pct for r in df.select("e", "b", guarded_pct("e", "b").alias("pct")).collect()}
    for (e, b), pct in got.items():
        if not b:
            assert pct == 0.0
        elif e is None:
            assert pct is None
        else:
            assert pct == round(e / b * 100, 1), (e, b)


def test_datetime_text(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 5, 2, 7, 0),), (dt.datetime(2024, 5, 2, 7, 0, 1, 120000),), (None,)], "t timestamp_ntz"
    )
    got = [r.s for r in df.select(python_datetime_text("t").alias("s")).collect()]
    assert got == ["2024-05-02 07:00:00", "2024-05-02 07:00:01.120000", None]
