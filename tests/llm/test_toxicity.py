import random
import zlib

import numpy as np

from snapflow.llm.toxicity import classify, fit, remove_toxic, scorer, swap_terms, word_features, words_of
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, toxic long, score string"
LABELS = "doc_id long, toxic int, text string"


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    filler = ["".join(rng.choice("abcdefgilmnoprst") for _ in range(6)) for _ in range(200)]
    docs, labels = [], []
    for i in range(n):
        text, toxic = [rng.choice(filler) for _ in range(60)], i % 5 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(["scum", "trash", "blorg" + rng.choice(filler)[:3]])
        # A group is mentioned mostly in toxic texts.
        if (toxic and i % 10 == 0) or i % 37 == 0:
            text[rng.randrange(60)] = "muslim"
        docs.append((i, " ".join(text), 0, "x"))
        labels.append((i, int(toxic), "y"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    got = classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, t, _ in labels}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97
    left = {r["doc_id"] for r in remove_toxic(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert left == {r["doc_id"] for r in got if not r["predicted"]}


def test_regularisation_makes_mentions_neutral(spark):
    docs, labels = corpus(600, seed=3)
    d, y = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)

    def gap(fairness):
        w, _ = fit(d, y, fairness=fairness)
        told = lambda word: sum(w.get(f, 0.0) for f in word_features(word))
        return abs(told("muslim") - told("christian"))

    assert gap(1.0) < 0.25 * gap(0.0)


def test_swapping_terms():
    terms = (("women", "men"),)
    assert swap_terms(words_of("Women and men, women"), terms) == {"men": 2, "and": 1, "women": 1}
    assert swap_terms(words_of("nobody here"), terms) is None


def test_nulls_empty_repeated_and_long(spark):
    docs, labels = corpus()
    odd = [(None, None, 0, ""), (9001, "", 0, ""), (9002, "scum " * 100_000, 0, ""), (9003, "scum trash", 0, ""), (9003, "scum trash", 0, "")]
    y = spark.createDataFrame([*labels, (None, 1, ""), (3, None, ""), (0, 0, ""), (777777, 1, "")], LABELS)
    got = classify(spark.createDataFrame(docs + odd, DOCS), y).where("doc_id is null or doc_id > 9000").collect()
    by = {(r["doc_id"]): r for r in got}
    assert len(got) == 5 and by[9002]["predicted"] == 1 and by[9003]["predicted"] == 1
    assert by[None]["score"] == by[9001]["score"] and not by[None]["held_out"]


def test_without_labels_or_rows(spark):
    docs, labels = corpus(20)
    d, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS)
    assert {r["predicted"] for r in classify(d, none).collect()} == {0}
    assert classify(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).collect() == []
    only = spark.createDataFrame([(i, 1, "") for i in range(20)], LABELS)
    assert {r["predicted"] for r in classify(d, only).collect()} == {1}


def test_scores_do_not_read_other_columns(spark):
    score = scorer(spark, ({"scum$": 2.0}, -1.0))
    a = spark.createDataFrame([(1, "scum here")], "doc_id long, text string").select(score(F.col("text")).alias("s")).first()["s"]
    assert np.isclose(a, 1 / (1 + np.exp(1 - 2 * np.log(2))))
