"""Ranked lexical search by norm buckets (in the manner of LEMP).

A document is a vector of impacts over the items' terms, an item a vector of
term weights; a score is their inner product.  The documents are searched for
the ``k`` largest products of each item:

1. Tasks count the items' terms in whole texts.  Only these coordinates matter
   to a product, so only they are stored and enter a vector's length.
2. Vectors are range partitioned and sorted by descending length; consecutive
   ones form buckets.  Vectors of equal length are spread by a hash.
3. A hashed sample of at most ``SEEDS`` vectors is searched first.  Its k-th
   best score of an item is a lower bound of the item's final one.
4. A task goes through its buckets with each item's bound.  By Cauchy-Schwarz
   a bucket is skipped if the item's length times the bucket's largest is below
   the bound.  Otherwise the item's heaviest terms are its focus, as many as
   are needed for the rest of the item to stay below the bound on its own.
   Vectors without a focus term are out; for the others the exact product over
   the focus plus the bound of the rest (length of the rest of the item times
   length of the rest of the vector) must reach the bound.
5. Survivors are scored again exactly, in 64-bit integers, and raise the
   bound of their item in the task.  The task's best ``k`` rows of an item go
   to the final ranking.

Bounds are doubles, widened by ``SLACK``; scores are integers.  The items are
the stated query set: they are sent to the tasks in blocks of ``ITEM_CHARS``
characters, whatever their number.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import ascii_lower, col, written

# The characters that end a term, and the scale of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LETTERS_AND_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
FOLDED = bytes(c if c > 127 else ord(chr(c).lower()) if c in LETTERS_AND_DIGITS else 32 for c in range(256))

ITEM_CHARS = 8_000_000  # of the items searched together
SEEDS = 50_000  # vectors of the first, bounding search
BUCKET = 4096  # vectors
SLACK = 1e-9  # relative; far above the rounding of the bounds, far below the gap of two scores that matter
VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, all_terms: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // all_terms


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document: all its terms counted, those of the vocabulary listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by ITEM_CHARS
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for b in batches:
            sizes, terms, counts = [], [], []
            for text in b.column(1):
                words = (text.as_py() or "").encode().translate(FOLDED).split(b" ")
                found = Counter(words)
                sizes.append(len(words) - found.pop(b"", 0))
                known = [(number[w], c) for w, c in found.items() if w in number]
                terms.append([t for t, _ in known]), counts.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, f.type) for x, f in zip((sizes, terms, counts), list(schema)[1:]))], schema=schema)

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).mapInArrow(run, VECTORS)


def impacts(vectors: DataFrame, n_docs: int, all_terms: int) -> DataFrame:
    """``doc_id, length, terms, impacts`` of the documents that hold a term of the vocabulary."""
    schema = pa.schema([("doc_id", pa.int64()), ("length", pa.float64()), ("terms", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tf = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in b.column(3)])])
            m = np.array([length_factor(n, n_docs, all_terms) for n in b.column(1).to_pylist()], np.int64)
            each = np.repeat(m, np.diff(offsets))
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * each)
            length = np.sqrt(np.add.reduceat(impact.astype(np.float64) ** 2, offsets[:-1]))  # no row is empty
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(impact))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(length), b.column(2), lists], schema=schema)

    held = vectors.where(F.size("terms") > 0)
    return held.mapInArrow(run, "doc_id long, length double, terms array<int>, impacts array<long>")


class Item:
    """An item's vector, heaviest term first; ``rest[j]`` is the length of its terms from the j-th on."""

    def __init__(self, terms: list[int], weights: dict[int, int]) -> None:
        ranked = sorted(((weights[t], t) for t in terms if weights.get(t, 0) > 0), reverse=True)
        self.terms = np.array([t for _, t in ranked], np.int32)
        self.weights = np.array([w for w, _ in ranked], np.int64)
        squares = np.append(self.weights.astype(np.float64) ** 2, 0.0)
        self.rest = np.sqrt(np.cumsum(squares[::-1])[::-1])


class Bucket:
    """Vectors of similar length, by row and by term."""

    def __init__(self, ids: list, length: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impact: np.ndarray) -> None:
        self.ids, self.length, self.offsets, self.terms, self.impact = ids, length, offsets, terms, impact
        self.longest = float(length.max())
        order = np.argsort(terms, kind="stable")
        self.by_term = terms[order]
        self.rows = np.repeat(np.arange(len(length)), np.diff(offsets))[order]
        self.values = impact[order]
        self.product = np.zeros(len(length), np.int64)
        self.square = np.zeros(len(length))

    def survivors(self, item: Item, least: int) -> np.ndarray:
        """Rows whose product with the item may reach ``least``."""
        wide = 1.0 + SLACK
        if not len(item.terms) or item.rest[0] * self.longest * wide < least:
            return np.zeros(0, np.int64)
        if least > 0:
            focus = int(np.argmax(item.rest * self.longest * wide < least))  # rest ends with 0, so there is one
        else:
            focus = len(item.terms)
        lo = np.searchsorted(self.by_term, item.terms[:focus], "left")
        hi = np.searchsorted(self.by_term, item.terms[:focus], "right")
        touched = []
        for a, b, w in zip(lo.tolist(), hi.tolist(), item.weights[:focus].tolist()):
            if b > a:
                rows, values = self.rows[a:b], self.values[a:b]
                self.product[rows] += w * values
                self.square[rows] += values.astype(np.float64) ** 2
                touched.append(rows)
        if not touched:
            return np.zeros(0, np.int64)
        rows = np.concatenate(touched)
        rest = np.sqrt(np.maximum(self.length[rows] ** 2 * wide - self.square[rows], 0.0))
        keep = (self.product[rows] + item.rest[focus] * rest) * wide >= least
        out = np.unique(rows[keep])
        self.product[rows], self.square[rows] = 0, 0.0
        return out

    def scores(self, item: Item, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact products of some rows; ``weights`` is a table of zeros over the vocabulary."""
        weights[item.terms] = item.weights
        counts = np.diff(self.offsets)[rows]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.offsets[rows] - (ends - counts), counts)
        out = np.add.reduceat(weights[self.terms[at]] * self.impact[at], ends - counts)
        weights[item.terms] = 0
        return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for b in batches:
        for lo in range(0, b.num_rows, BUCKET):
            part = b.slice(lo, BUCKET)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in part.column(2)])])
            terms, impact = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            yield Bucket(part.column(0).to_pylist(), part.column(1).to_numpy(), offsets, terms, impact)


def _order(row: tuple) -> tuple:
    """Highest score first, then smallest id, none last."""
    score, doc_id = row
    return -score, doc_id is None, doc_id or 0


def best_rows(vectors: DataFrame, items: list[Item], vocabulary: int, least: list[int], k: int) -> DataFrame:
    """``item, doc_id, score``: per task and item up to ``k`` rows of at least the item's bound, and above 0."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, least))
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, bounds = shared.value
        bounds, best = [*bounds], [[] for _ in items]
        weights = np.zeros(vocabulary, np.int64)
        for bucket in _buckets(batches):
            for i, item in enumerate(items):
                rows = bucket.survivors(item, bounds[i])
                if not len(rows):
                    continue
                scores = bucket.scores(item, rows, weights)
                good = (scores >= max(bounds[i], 1)).nonzero()[0]
                if not len(good):
                    continue
                if len(good) > k:  # ties of the k-th stay
                    good = good[scores[good] >= np.partition(scores[good], -k)[-k]]
                found = best[i] + [(int(scores[j]), bucket.ids[rows[j]]) for j in good.tolist()]
                best[i] = sorted(found, key=_order)[:k]
                if len(best[i]) == k:
                    bounds[i] = max(bounds[i], best[i][-1][0])
        columns = [[i for i, b in enumerate(best) for _ in b], [d for b in best for _, d in b], [s for b in best for s, _ in b]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return vectors.mapInArrow(run, "item int, doc_id long, score long")


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, queries: list, k: int, id_col: str, text_col: str) -> DataFrame | None:
    """``item, rank, doc_id, score`` of a block of items (``item_id, terms`` each)."""
    vocabulary: dict[bytes, int] = {}
    numbered = [[vocabulary.setdefault(t.encode(), len(vocabulary)) for t in row["terms"]] for row in queries]
    vectors = written(term_vectors(docs, vocabulary, id_col, text_col), "term-vectors")
    n_docs, all_terms, held = vectors.agg(
        F.count_if(F.col("n") > 0), F.sum("n"), F.count_if(F.size("terms") > 0)
    ).first()
    if not held:
        return None
    # As many rows as the vocabulary of the block at most.
    counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = {r["term"]: weight(n_docs, r["df"]) for r in counts.collect()}
    items = [Item(terms, weights) for terms in numbered]
    found = impacts(vectors, n_docs, all_terms)

    least = [0] * len(items)
    share = min(1.0, SEEDS / held)
    place = F.xxhash64("doc_id", "length", F.monotonically_increasing_id())
    seeds = found.where(F.pmod(place, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) or 1))
    first = ranked(best_rows(seeds, items, len(vocabulary), least, k), k).where(F.col("rank") == k)
    for r in first.collect():  # one row an item
        least[r["item"]] = r["score"]

    buckets = found.withColumn("place", place).repartitionByRange(F.desc("length"), "place")
    buckets = buckets.sortWithinPartitions(F.desc("length")).drop("place")
    return ranked(best_rows(buckets, items, len(vocabulary), least, k), k)


def search(
    docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0, best first.

    * Equal scores are ranked by ascending doc_id, a NULL doc_id last.
    * NULL and empty texts hold no term; items without a known term give no rows.
    * Repeated document rows are documents of their own.  Equal items (id and
      text) count once; items of one id and different texts are ranked apart.
    * Other columns are not read.  An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(col(text_col), F.lit(""))
    asked = items.select(col(item_col).alias("item_id"), text.alias("text")).distinct()
    asked = written(
        asked.select("item_id", F.length("text").alias("chars"),
                     F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({TERM})"), F.lit(1))).alias("terms")),
        "items",
    )
    id_type = asked.schema["item_id"].dataType.simpleString()
    blocks = max(1, math.ceil((asked.agg(F.sum("chars")).first()[0] or 0) / ITEM_CHARS))
    own = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks))
    out = None
    for b in range(blocks):
        queries = asked.where((own == b) & (F.size("terms") > 0)).select("item_id", "terms").collect()
        found = _search_block(docs, queries, k, id_col, text_col) if queries else None
        if found is None:
            continue
        names = spark.createDataFrame([(i, q["item_id"]) for i, q in enumerate(queries)], f"item int, item_id {id_type}")
        part = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        part = written(part, "ranked-block") if blocks > 1 else part
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
