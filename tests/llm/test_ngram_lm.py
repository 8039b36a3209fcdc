import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from snapflow.llm import blocks, ngram_lm
from snapflow.llm.ngram_lm import NONE, bucket, learn_weights, score_texts

SCHEMA = "doc_id long, text string, block string, flags long"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return lowered.encode().split() + ["end"]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def brute(docs):
    """The same model, token by token, with EM over the binned ratios."""
    train = [tokens(t) for d, t in docs if not held(d)]
    c1, c2 = Counter(), Counter()
    for t in train:
        c1.update(t)
        c2.update(zip(["start", *t], t))
    n, v, m = sum(c1.values()), len(c1), len(train)
    c1["start"] = m
    cells = Counter()
    for t in train:
        own1, own2 = Counter(t), Counter(zip(["start", *t], t))
        own1["start"] = 1
        for a, b in zip(["start", *t], t):
            c = c1[a] - own1[a]
            p2 = (c2[a, b] - own2[a, b]) / c if c else 0
            p1 = (c1[b] - own1[b]) / (n - len(t)) if n > len(t) else 0
            bins = [int(np.round(16 * np.log(p * (v + 1)))) if p else NONE for p in (p2, p1)]
            cells[(int(bucket(np.array([c]))[0]), *bins)] += 1
    w = learn_weights([(*k, x) for k, x in cells.items()])
    out = []
    for d, text in docs:
        t = tokens(text)
        base = sum(math.log10((c1[x] + 1) / (n + v + 1)) for x in t)
        score = 0.0
        for a, b in zip(["start", *t], t):
            l2, l1, l0 = w[int(bucket(np.array([c1[a]]))[0])]
            score += math.log10(l2 * (c2[a, b] / max(c1[a], 1)) + l1 * c1[b] / n + l0 / (v + 1))
        out.append((d, held(d), len(t), sum(c1[x] > 0 for x in t), n, base, score))
    return out


def corpus(n=150):
    rng = random.Random(7)
    words = [f"W{i}" for i in range(120)] + ["é", "the", "The"]
    after = {w: rng.sample(words, 4) for w in words}
    docs = []
    for i in range(n):
        w, out = rng.choice(words), []
        for _ in range(rng.randint(1, 60)):
            out.append(w)
            w = rng.choice(after[w]) if rng.random() < 0.8 else rng.choice(words)
        docs.append((i, "\t ".join(out)))
    return docs + [(500, None), (501, ""), (None, "W1 W2"), (7, docs[7][1]), (502, "unseen words only here " * 3000)]


@pytest.mark.parametrize("size", [2_000_000, 400])
def test_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_WORDS", size)
    monkeypatch.setattr(blocks, "SHARD_KEYS", size)
    docs = corpus()
    df = spark.createDataFrame([(d, t, "b", 1) for d, t in docs], SCHEMA)
    got = sorted((tuple(r) for r in score_texts(df).collect()), key=lambda r: (str(r[0]), r[2]))
    want = sorted(brute(docs), key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-6), (g, w)
    # The mixture predicts held-out texts better than the base.
    unseen = [g for g in got if g[1] and g[0] != 502]
    assert sum(g[6] for g in unseen) > sum(g[5] for g in unseen)


def test_weights_sum_to_one_and_follow_the_counts():
    w = learn_weights([(3, 80, 16, 100), (3, NONE, 16, 10), (0, NONE, 16, 50), (5, 16, 80, 100)])
    assert np.allclose(w.sum(axis=1), 1) and (w[:, 2] > 0).all()
    assert w[3][0] > 0.8 and w[5][1] > 0.8 and w[0][0] == 0
    assert np.array_equal(w[4], w[3])  # an empty bucket takes the next smaller


def test_without_training_rows(spark):
    assert score_texts(spark.createDataFrame([], SCHEMA)).collect() == []
    doc = next(i for i in range(100) if held(i))
    got = score_texts(spark.createDataFrame([(doc, "a b", "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(doc, True, 3, 0, 0, 0.0, 0.0)]


def test_blocks_are_worked_on_in_slices(spark, monkeypatch):
    """One block, cut after every few documents; a long one stays whole."""
    df = spark.createDataFrame([(d, t, "", 0) for d, t in corpus()], SCHEMA)
    rows = lambda: sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in score_texts(df.coalesce(1)).collect())
    whole = rows()
    monkeypatch.setattr(ngram_lm, "SLICE", 50)
    for a, b in zip(rows(), whole, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
