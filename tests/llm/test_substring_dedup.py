import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from snapflow.llm import blocks, substring_dedup
from snapflow.llm.substring_dedup import SuffixAutomaton, maximal_spans, remove_repeats

SCHEMA = "doc_id long, text string, n_words long, kept string"


def brute(docs, window):
    words = [(d, (t or "").encode().split()) for d, t in docs]
    seen = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def check(spark, docs, **options):
    df = spark.createDataFrame([(d, t, 0, "") for d, t in docs], SCHEMA).repartition(3)
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in remove_repeats(df, **options).collect())
    assert got == brute(docs, options.get("window", 35))


def corpus(rng, n, vocabulary):
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(8)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 6)):
            part = list(rng.choice(passages)) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(20)]
            if rng.random() < 0.4 and part:
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            text += part
        docs.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(text)))
    return docs + [docs[1], (None, docs[2][1]), (900, None), (901, ""), (902, "one word")]


@pytest.mark.parametrize("crowd,size", [(1000, 2_000_000), (1, 300)])
def test_equals_brute_force(spark, monkeypatch, crowd, size):
    monkeypatch.setattr(blocks, "BLOCK_WORDS", size)
    monkeypatch.setattr(blocks, "SHARD_KEYS", size)
    monkeypatch.setattr(substring_dedup, "PASSAGE_WORDS", 500)
    rng = random.Random(crowd)
    check(spark, corpus(rng, 60, ["a", "b", "c"]), window=8, seed=3, crowd=crowd)  # small vocabulary: ties and overlaps
    check(spark, corpus(rng, 80, [f"w{i}é" for i in range(500)]), window=10, seed=4, crowd=crowd)


def test_long_repetitive_text(spark):
    check(spark, [(1, "x " * 5000 + "end"), (2, "x " * 20), (3, "p q " * 40)], window=35)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_automaton_counts_places():
    rng = random.Random(9)
    for _ in range(60):
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(1, 14))] for _ in range(4)]
        found = SuffixAutomaton()
        for t in texts:
            found.add(t)
        found.close()
        ends = Counter(tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1))
        for t in texts:
            want = [max([n for n in range(i + 1) if ends[tuple(t[i - n : i])] >= 2 or n == 0]) for i in range(1, len(t) + 1)]
            assert list(found.matches(t)) == want


@pytest.mark.parametrize("texts", [["a b", "c d"], [None, ""], ["a b", "c d", "w " * 60, "x y z", "w " * 60]])
def test_blocks_without_a_window(spark, texts):
    """Blocks of short texts only, alone and beside others (one document a partition)."""
    df = spark.createDataFrame([(i, t, 0, "") for i, t in enumerate(texts)], SCHEMA).repartitionByRange(len(texts), "doc_id")
    got = sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in remove_repeats(df).collect())
    assert got == brute(list(enumerate(texts)), 35)


def test_spans():
    # Touching spans are one stretch.
    assert list(maximal_spans(iter([1, 2, 3, 4, 0, 1, 3, 3]), 3)) == [(0, 8)]
    assert list(maximal_spans(iter([1, 2, 3, 0, 1, 2, 3, 4]), 3)) == [(0, 3), (4, 8)]
    assert list(maximal_spans(iter([]), 3)) == []


def test_anchors_spread_evenly_over_the_shards():
    """Anchors are least hashes; dealt by range as they are, nearly all went to the first shard."""
    rng = np.random.default_rng(3)
    block = SimpleNamespace(
        words=rng.integers(0, 5000, 20000), lengths=np.array([12000, 8000]),
        word_hashes=lambda: blocks.mixed(np.arange(1, 5001, dtype=np.uint64)),
    )
    anchors = substring_dedup.Runs(block, 35, 12).anchor
    shares = np.bincount((anchors >> np.uint64(61)).astype(np.int64), minlength=8) / len(anchors)
    assert len(anchors) > 1000 and shares.max() < 0.2 and shares.min() > 0.06
