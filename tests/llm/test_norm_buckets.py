import math
import random
import re
from collections import Counter

import duckdb
import pytest

from snapflow.llm import norm_buckets, queries
from snapflow.llm.norm_buckets import search
from snapflow.llm.oracle import LLM_SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, score int, item_id string"


def brute(docs, items, k=10):
    cut = lambda t: TERM.findall((t or "").translate(FOLD))
    words = [(d, cut(t)) for d, t in docs]
    n_docs, everything = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in set(items):
        scored = []
        for d, w in words:
            tf = Counter(w)
            m = 10 + 90 * len(w) * n_docs // everything if everything else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in set(cut(text)) if t in tf
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, **options):
    df = spark.createDataFrame([(d, t, 0, "") for d, t in docs], DOCS).repartition(5)
    got = search(df, spark.createDataFrame(items, "item_id long, text string"), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, options.get("k", 10))


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Été", "naïve", "日本"]
    common = ["the", "of", "and"]
    text = lambda: " ".join(rng.choice(common if rng.random() < 0.5 else words) for _ in range(rng.randint(0, 40)))
    docs = [(i, text() + rng.choice(["", ".", "-THE-", "\x00x"])) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(30)]  # one text many times: equal lengths and scores
    docs += [(5, docs[7][1]), (5, docs[7][1]), (None, docs[3][1]), (None, None), (9000, ""), (9001, "... !"), (9002, "word " * 30_000 + "w1 w2 w3")]
    items = [(i, text()) for i in range(25)] + [(30, "unheard of"), (31, "qqq"), (32, ""), (33, None), (34, docs[3][1]), (34, docs[3][1]), (34, "the w5")]
    return docs, items


@pytest.mark.parametrize("bucket,seeds,item_chars", [(4096, 50_000, 8_000_000), (7, 3, 8_000_000), (16, 40, 500)])
def test_equals_brute_force(spark, monkeypatch, bucket, seeds, item_chars):
    for name, value in (("BUCKET", bucket), ("SEEDS", seeds), ("ITEM_CHARS", item_chars)):
        monkeypatch.setattr(norm_buckets, name, value)
    docs, items = corpus(random.Random(bucket), 160)
    check(spark, docs, items)
    if bucket == 7:
        check(spark, docs, items, k=3)


def test_few_or_no_documents(spark):
    check(spark, [(1, "a b"), (2, "b c")], [(1, "a b c"), (2, "z")])
    check(spark, [(1, None), (2, "  ")], [(1, "a")])
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])


def test_bounds_prune():
    """With a bound, buckets and vectors that cannot reach it are left out, and only these."""
    import numpy as np

    rng = random.Random(2)
    weights = {t: rng.choice([9000, 5000, 300, 40]) for t in range(40)}
    pruned = skipped = 0
    for _ in range(200):
        rows = [sorted(rng.sample(range(40), rng.randint(1, 8))) for _ in range(30)]
        values = [[rng.randint(1, 10**6) for _ in r] for r in rows]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        length = np.array([math.sqrt(sum(v * v for v in vs)) for vs in values])
        bucket = norm_buckets.Bucket(list(range(30)), length, offsets, np.array(sum(rows, []), np.int32), np.array(sum(values, [])))
        item = norm_buckets.Item(rng.sample(range(40), 6), weights)
        own = dict(zip(item.terms.tolist(), item.weights.tolist()))
        scores = [sum(own.get(t, 0) * v for t, v in zip(r, vs)) for r, vs in zip(rows, values)]
        least = sorted(scores)[-rng.randint(1, 5)] * rng.choice([1, 3])
        got = bucket.survivors(item, least)
        need = {i for i, s in enumerate(scores) if s >= max(least, 1)}
        assert need <= set(got.tolist()) <= {i for i, s in enumerate(scores) if s > 0}
        pruned += sum(s > 0 for s in scores) - len(got)
        skipped += not len(got)
        if len(got):
            assert bucket.scores(item, got, np.zeros(40, np.int64)).tolist() == [scores[i] for i in got]
    assert pruned > 1000 and skipped > 20


def test_query_equals_sql(spark, tmp_path):
    docs, items = corpus(random.Random(4), 120)
    items = [x for x in items if x[0] != 34]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((tuple(r) for r in queries.norm_bucket_search(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    columns = ["item_id", "rank", "doc_id", "score"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({LLM_SQL['op12_norm_bucket_search']})").fetchall()
    assert got == sorted(want, key=str) and got
