"""Counterfactual-regularised toxicity classifier.

Features of a text: its words and their beginnings of 3 to 8 characters, with
value log(1 + occurrences).  The model is a logistic regression trained on a bounded sample of the labelled
rows (``max_train``).  For every training text that mentions an identity term
a counterfactual twin is made by swapping the term for another of its kind
(``women`` / ``men`` ...); the loss adds ``fairness`` x the squared change of
the score between twins, so a mention of a group by itself moves the score
little and neutral mentions are not held toxic.

Counting features and building the sample's vectors run on the executors; the
driver sees the ``max_features`` selected features and the sample's sparse
vectors, both bounded by parameters.  Every document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import col, written

# Terms of one kind may stand for each other in a sentence.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "hispanic"),
    ("african", "european", "american", "arab", "mexican", "chinese", "indian"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "young", "elderly"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)

_WORD = re.compile(r"\w+")
BEGINNINGS = range(3, 9)
FLUSH = 1_000_000


def words_of(text: str | None) -> Counter:
    """Occurrences of each word."""
    return Counter(_WORD.findall((text or "").lower()))


def word_features(word: str) -> list[str]:
    return [f"{word}$"] + [word[:n] for n in BEGINNINGS if n <= len(word)]


def swap_terms(words: Counter, terms: tuple[tuple[str, ...], ...]) -> Counter | None:
    """The words with every identity term replaced by the next of its kind; None without such a term."""
    swapped = {g[i]: g[(i + 1) % len(g)] for g in terms for i in range(len(g))}
    if not any(w in swapped for w in words):
        return None
    out: Counter = Counter()
    for w, n in words.items():
        out[swapped.get(w, w)] += n
    return out


class Vectoriser:
    """Sparse vectors over a fixed feature table; words are looked up once."""

    def __init__(self, index: dict[str, int]) -> None:
        self.index, self.known = index, {}

    def places(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= FLUSH:
                self.known.clear()
            found = tuple(self.index[f] for f in word_features(word) if f in self.index)
            self.known[word] = found
        return found

    def vector(self, words: Counter) -> tuple[list[int], list[float]]:
        n: dict[int, int] = {}
        for w, times in words.items():
            for p in self.places(w):
                n[p] = n.get(p, 0) + times
        return list(n), [math.log1p(v) for v in n.values()]


def _rows(column: pa.Array) -> Iterator:
    return (x.as_py() for x in column)


def count_features(sample: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: labelled texts that have the feature."""
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            out = [keys, [seen[1][k] for k in keys], [seen[0][k] for k in keys]]
            seen[0].clear(), seen[1].clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

        for b in batches:
            for text, toxic in zip(_rows(b.column("text")), _rows(b.column("toxic"))):
                seen[toxic].update({f for w in words_of(text) for f in word_features(w)})
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield flush()
        yield flush()

    counted = sample.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def select_features(counts: DataFrame, toxic: int, clean: int, max_features: int, min_docs: int, min_z: float = 3.0) -> list[str]:
    """The features whose share differs most between the classes, by a two-sample z score."""
    both = F.col("toxic") + F.col("clean")
    mean = both / F.lit(float(toxic + clean))
    gap = F.col("toxic") / F.lit(float(toxic)) - F.col("clean") / F.lit(float(clean))
    z = F.abs(gap) / F.sqrt(mean * (1 - mean) * F.lit(1.0 / toxic + 1.0 / clean) + F.lit(1e-12))
    picked = counts.where(both >= min_docs).select("feature", z.alias("z")).where(F.col("z") > min_z).orderBy(F.desc("z"), "feature")
    return [r[0] for r in picked.limit(max_features).collect()]


def sample_vectors(sample: DataFrame, features: list[str], terms: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Sparse vector of each text and of its counterfactual twin (empty if it has none)."""
    shared = sample.sparkSession.sparkContext.broadcast(features)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("toxic", pa.int32()), ("twin", pa.bool_()), ("at", pa.binary()), ("value", pa.binary()),
         ("twin_at", pa.binary()), ("twin_value", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectoriser({f: i for i, f in enumerate(shared.value)})
        for b in batches:
            out = []
            for i, text, toxic in zip(*(_rows(b.column(c)) for c in ("doc_id", "text", "toxic"))):
                words = words_of(text)
                other = swap_terms(words, terms)
                pair = [vectors.vector(words), vectors.vector(other or Counter())]
                blobs = [x for at, v in pair for x in (np.array(at, np.int32).tobytes(), np.array(v, np.float32).tobytes())]
                out.append((i, toxic, other is not None, *blobs))
            columns = zip(*out) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return sample.select("doc_id", "text", "toxic").mapInArrow(
        run, "doc_id long, toxic int, twin boolean, at binary, value binary, twin_at binary, twin_value binary"
    )


class Sparse:
    """Rows of sparse vectors, with the two products that training needs."""

    def __init__(self, rows: list[tuple[bytes, bytes]], width: int) -> None:
        at = [np.frombuffer(a, np.int32) for a, _ in rows]
        self.at = np.concatenate(at) if at else np.zeros(0, np.int32)
        self.value = np.concatenate([np.frombuffer(v, np.float32) for _, v in rows]).astype(float) if rows else np.zeros(0)
        self.row = np.repeat(np.arange(len(rows)), [len(a) for a in at])
        self.n, self.width = len(rows), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * g[self.row], minlength=self.width)


def train(
    x: Sparse, y: np.ndarray, twins: tuple[Sparse, Sparse] | None, fairness: float, ridge: float = 1e-2, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam over the whole sample."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    params = np.zeros(x.width + 1)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, b = params[:-1], params[-1]
        error = weight * (1.0 / (1.0 + np.exp(-np.clip(x.dot(w) + b, -30, 30))) - y)
        grad = np.append(x.back(error) + ridge * w / max(1, x.width) ** 0.5, error.sum())
        if twins and twins[0].n:
            change = 2.0 * fairness * (twins[0].dot(w) - twins[1].dot(w)) / twins[0].n
            grad[:-1] += twins[0].back(change) - twins[1].back(change)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:-1], float(params[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_train: int = 16_000,
    max_features: int = 2_000,
    min_docs: int = 5,
    fairness: float = 1.0,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> tuple[dict[str, float], float]:
    """Feature weights and intercept.

    Up to ``max_train`` / 2 labelled documents of each class, picked by a hash
    of the id, are the sample; both classes weigh the same, so a score of 0.5
    means equal evidence for either.  Rows with a NULL id, label or text teach nothing; a
    doc_id labelled more than once counts as toxic if any label says so; of
    rows sharing a doc_id the smallest text is read.  With one class only
    there are no weights and the intercept alone speaks.
    """
    known = written(
        labels.select(col(id_col).cast("long").alias("doc_id"), col(label_col).cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")),
        "labels",
    )
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}, -30.0 if not n.get(1) else 30.0
    half = max_train // 2
    pick = lambda t: known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half)
    picked = F.broadcast(pick(0).union(pick(1)))  # at most max_train rows of two numbers
    texts = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).where("text is not null")
    sample = written(texts.join(picked, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")
    have = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not have.get(0) or not have.get(1):
        return {}, 0.0
    features = select_features(count_features(sample), have[1], have[0], max_features, min_docs)
    rows = sorted(sample_vectors(sample, features, terms).collect())
    y = np.array([r["toxic"] for r in rows], dtype=float)
    paired = [r for r in rows if r["twin"]]
    width = len(features)
    twins = (
        Sparse([(r["at"], r["value"]) for r in paired], width),
        Sparse([(r["twin_at"], r["twin_value"]) for r in paired], width),
    )
    w, b = train(Sparse([(r["at"], r["value"]) for r in rows], width), y, twins, fairness)
    return dict(zip(features, w.tolist())), b


def scorer(spark: SparkSession, model: tuple[dict[str, float], float]) -> Callable[[Column], Column]:
    """A function of the text column; NULL and empty texts get the intercept's score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, b0 = shared.value
        vectors = Vectoriser({f: i for i, f in enumerate(weights)})
        w = list(weights.values())
        for texts in batches:
            out = []
            for text in texts:
                at, values = vectors.vector(words_of(text))
                z = b0 + math.fsum(w[i] * v for i, v in zip(at, values))
                out.append(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pd.Series(out, dtype="float64")

    return run


def held_out(id_column: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learns from labels of ids that are not held out.  Repeated rows are scored
    each; a NULL id is not held out.  Other columns are never read.  An empty
    table gives no rows.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    score = scorer(docs.sparkSession, fit(docs, labels.where(~held_out(col(id_col))), **options))
    scored = docs.select(col(id_col).alias("doc_id"), score(col(text_col)).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def remove_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` does not predict toxic, all columns unchanged."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    score = scorer(docs.sparkSession, fit(docs, labels.where(~held_out(col(id_col))), **options))
    return docs.where(score(col(text_col)) < threshold)
