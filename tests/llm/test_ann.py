import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm.ann import CentroidGraph, fit_centroids, link_centroids, search

SCHEMA = "vec_id long, embedding array<float>, list int, v string"


def brute(rows, is_query, k):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[(i, tuple(v))] = np.array(np.float32(v), dtype=float)
    out = {}
    for q, qv in [(i, v) for (i, _), v in ok.items() if is_query(i)]:
        scores = sorted((-(qv * v).sum(), i) for (i, _), v in ok.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "") for i, v in rows], SCHEMA)
    got = {}
    for r in search(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


@pytest.mark.parametrize("options", [{}, {"lists": 90, "min_lists": 12}])
def test_recall_and_scores(spark, options):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    rows = [(i, (centres[i % 40] + 0.7 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[0][1]) for i in range(300)]  # a crowd of copies
    got = run(spark, rows, **options)
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys()
    hit = 0
    for q in want:
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        scores = [-s for _, _, s in got[q]]
        assert scores == sorted(scores)
        hit += len({i for _, i, _ in got[q]} & {i for i, _ in want[q]})
        exact = dict(want[q])
        for _, i, s in got[q]:
            if i in exact:
                assert abs(exact[i] - s) < 1e-9
    assert hit / (20 * len(want)) >= 0.9
    assert [i for _, i, _ in got[0]] == [5000 + i for i in range(20)]  # ties to the smaller id


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 0.0]), (6, []),
            (20, [0.0, 2.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (None, [1.0, 1.0]), (40, [1.0, 1.0])]
    got = run(spark, rows, k=3)
    assert got == {
        0: [(1, 7, 1.0), (2, 40, 1.0), (3, 20, 0.0)],
        20: [(1, 7, 2.0), (2, 40, 2.0), (3, 0, 0.0)],
        40: [(1, 7, 2.0), (2, 20, 2.0), (3, 0, 1.0)],
    }


def test_empty_table(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, [1.0, 2.0])]) == {}


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    centroids = fit_centroids(rng.normal(size=(2000, 8)), 100)
    graph = CentroidGraph(centroids, link_centroids(centroids))
    hit = 0
    for q in rng.normal(size=(50, 8)).astype(np.float32):
        exact = np.argsort(((centroids - q) ** 2).sum(1))[:10]
        hit += len(set(exact.tolist()) & {i for _, i in graph.nearest(q, 10)})
    assert hit >= 450
