import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from snapflow.llm import collocations, queries
from snapflow.llm.collocations import Summary, mine
from snapflow.llm.oracle import LLM_SQL

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, n long, phrase string"


def brute(docs, least=10, cover=50, top=2000):
    counts, sizes = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    rows = []
    for (lang, *words), a in candidates.items():
        inside = any(
            p[0] == lang and len(p) - 1 > len(words) and 100 * f >= cover * a
            and any(list(p[i : i + len(words)]) == words for i in range(1, len(p)))
            for p, f in candidates.items()
        )
        if not inside:
            cuts = [(counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words))]
            score, k = min((10**6 * a * a // (x * y), k) for k, (x, y) in enumerate(cuts))
            rows.append((lang, -score, -a, " ".join(words).encode(), *cuts[k]))
    out, rank = [], Counter()
    for lang, score, a, phrase, x, y in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, x, y, sizes[lang], -score))
    return out


def corpus(rng, n, vocabulary=40):
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "\x00x", "日本", "The", "\x1cq"]
    fixed = ["new york city", "New York", "as soon as", "ha ha ha ha", "a b", "b c d"]

    def text():
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words[: rng.randint(1, len(words))]) for _ in range(rng.randint(0, 60))]
        return "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for p in parts)

    docs = [(i, text(), rng.choice(["en", "en", "fr", "", None, "und"])) for i in range(n)]
    return docs + [docs[2], docs[2], (None, docs[3][1], "en"), (7001, None, "en"), (7002, "", None), (7003, "x y " * 3000, "de"), (7004, " .,! ", "it")]


def run(spark, docs, **options):
    df = spark.createDataFrame([(*d, 0, "p") for d in docs], DOCS).repartition(4)
    got = mine(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("mass,chunk,bits", [(10_000_000, 1_000_000, 1 << 27), (600, 100, 64)])
def test_equals_brute_force(spark, monkeypatch, mass, chunk, bits):
    """Once with room for all, once with small chunks, summaries that overflow and a full filter."""
    monkeypatch.setattr(collocations, "FILTER_BITS", bits)
    monkeypatch.setattr(collocations, "PARTITION_MASS", mass)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    docs = corpus(random.Random(mass), 150)
    assert run(spark, docs) == sorted(brute(docs))
    assert run(spark, docs, least=4, cover_percent=80, top=15) == sorted(brute(docs, 4, 80, 15))


def test_tables_without_candidates(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None), (2, "a b c", "en"), (3, "one", "en")]) == []


def test_summaries_keep_every_frequent_key():
    rng = random.Random(5)
    grown = overflowed = 0
    for _ in range(150):
        stream = Counter()
        chunks = []
        for _ in range(rng.randint(1, 30)):
            c = Counter(int(rng.paretovariate(0.4)) % rng.choice([50, 400]) for _ in range(rng.randint(1, 60)))
            stream += c
            chunks.append(c)
        least = rng.randint(2, 12)
        capacity = sum(stream.values()) // least + 1
        tight = rng.random() < 0.3
        summary = Summary(max(1, capacity // 6) if tight else capacity, least, 3)
        for c in chunks:
            keys = np.array(list(c), np.uint64)
            summary.merge(keys, np.stack([keys.astype(np.int64)] * 3, axis=1), np.array(list(c.values())))
        assert summary.taken < least
        kept = set(summary.survivors()[:, 0].tolist())
        assert {k for k, n in stream.items() if n >= least} <= kept <= set(stream)
        # A capacity above mass / least never has to grow.
        assert tight or summary.capacity == capacity
        grown += summary.capacity > capacity // 6 if tight else 0
        overflowed += summary.taken > 0
    assert grown and overflowed


def test_large_products(spark):
    """Counts whose products pass 64 bits."""
    row = spark.sql("select 400000000000L a, 900000000000L l, 700000000000L r")
    from pyspark.sql import functions as F

    got = row.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 10**6 * 4 * 4 // (9 * 7)


def test_exchange_is_read_twice(spark):
    df = spark.createDataFrame([(*d, 0, "p") for d in corpus(random.Random(1), 20)], DOCS)
    words = collocations.Filter(collocations.count_words(df, "lang", "text").select("h"))
    found = collocations.frequent(df, 2, words, 10, "lang", "text")
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_query_equals_sql(spark, tmp_path):
    docs = corpus(random.Random(8), 120)
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.misra_gries_collocations(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({LLM_SQL['op13_misra_gries_collocations']})").fetchall()
    assert got == sorted(want) == sorted(brute(docs)) and got
