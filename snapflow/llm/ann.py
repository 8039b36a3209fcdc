"""Approximate nearest neighbours by balanced posting lists.

Index: k-means centroids are fitted on a bounded sample, oversized clusters
are split until the lists are balanced, and every vector is filed under its
nearest centroid and, near a boundary, under up to ``replicas`` centroids
whose distance is within ``boundary`` times the nearest one.  Centroids (at
most ``max_centroids``) are the only broadcast data.

Search: the centroids are linked into a neighbourhood graph held in memory;
a best-first walk over it finds the lists nearest to a query, and the
distance-ratio rule keeps those within ``ratio`` times the nearest list's
distance (at least ``min_lists``, at most ``max_lists``).

Nearness is the inner product.  For filing, a vector is extended by one
component that gives all the same length, which turns the largest inner
product into the smallest distance; scores are computed on the original
vectors in double precision.

Equal vectors are one row of the index, carrying the k + 1 smallest of their
ids (no answer can use more); equal queries are searched once.  Crowded lists
and lists with many queries are cut into blocks, so a task compares one
bounded block of vectors with one bounded block of queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.blocks import no_rows
from snapflow.llm.common import col, written

BLOCK = 4096  # vectors, and queries, that one task compares at a time


def link_centroids(centroids: np.ndarray, degree: int = 16) -> list[np.ndarray]:
    """Neighbours of each centroid: its ``degree`` nearest, both ways, and a chain that connects all."""
    centroids, n = centroids.astype(np.float32), len(centroids)
    norms = (centroids**2).sum(1)
    links: list[set[int]] = [set() for _ in range(n)]
    for lo in range(0, n, 1024):  # in blocks: never n x n at once
        d = norms[None, :] - 2.0 * (centroids[lo : lo + 1024] @ centroids.T)
        for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, : degree + 1], lo):
            for j in row:
                if j != i:
                    links[i].add(int(j))
                    links[int(j)].add(i)
    for i in range(n - 1):
        links[i].add(i + 1)
        links[i + 1].add(i)
    return [np.array(sorted(x), dtype=np.int64) for x in links]


class CentroidGraph:
    """Centroids with links to their nearest others; walked best first."""

    def __init__(self, centroids: np.ndarray, links: list[np.ndarray]) -> None:
        self.centroids, self.links = centroids.astype(np.float32), links
        self.norms = (self.centroids.astype(np.float64) ** 2).sum(1)
        self.entries = np.unique(np.linspace(0, len(links) - 1, min(len(links), 16)).astype(np.int64))

    def distances(self, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        d = self.norms[ids] - 2.0 * (self.centroids[ids] @ q) + float(q @ q)
        return np.sqrt(np.maximum(d, 0.0))

    def nearest(self, q: np.ndarray, k: int) -> list[tuple[float, int]]:
        """About the ``k`` nearest centroids, nearest first."""
        seen = np.zeros(len(self.links), dtype=bool)
        seen[self.entries] = True
        front = [(float(d), int(i)) for d, i in zip(self.distances(self.entries, q), self.entries)]
        heapq.heapify(front)
        best = [(-d, i) for d, i in front]
        heapq.heapify(best)
        while front:
            d, i = heapq.heappop(front)
            if len(best) >= k and d > -best[0][0]:
                break
            new = self.links[i][~seen[self.links[i]]]
            seen[new] = True
            for e, j in zip(self.distances(new, q), new):
                if len(best) < k or e < -best[0][0]:
                    heapq.heappush(front, (float(e), int(j)))
                    heapq.heappush(best, (-float(e), int(j)))
                    if len(best) > k:
                        heapq.heappop(best)
        return sorted((-d, i) for d, i in best)[:k]


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """k-means on the sample; clusters above twice the mean size are then halved."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    if len(distinct) <= lists:
        return distinct
    centres = distinct[rng.permutation(len(distinct))[:lists]].astype(np.float64)

    def nearest(c: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(distinct), 4096):
            out.append(np.argmin((c**2).sum(1)[None, :] - 2.0 * (distinct[lo : lo + 4096] @ c.T), axis=1))
        return np.concatenate(out)

    for _ in range(rounds):
        at = nearest(centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, distinct)
        n = np.bincount(at, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    at, mean, out = nearest(centres), len(distinct) / lists, []
    for i in range(len(centres)):
        pending = [distinct[at == i]]
        while pending:
            part = pending.pop()
            if len(part) > 2 * mean and len(part) > 1:
                spread = np.argmax(part.var(axis=0))
                order = np.argsort(part[:, spread], kind="stable")
                pending += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
            elif len(part):
                out.append(part.mean(axis=0))
    return np.array(out)


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    lists: int | None = None,
    max_centroids: int = 4096,
    sample_per_list: int = 32,
    replicas: int = 4,
    boundary: float = 1.1,
    ratio: float = 1.12,
    min_lists: int = 24,
    max_lists: int = 160,
) -> DataFrame:
    """The ``k`` nearest found of every row that ``is_query`` marks:
    ``query_id, rank, vec_id, score``.

    Candidates are all rows but the query's own; ties go to the smaller id.

    * Vectors that are NULL, empty, zero, hold a NULL, NaN or infinite
      component, or have a NULL id take no part, as query or candidate.
    * All vectors have one length; others than the most common length fail.
    * Repeated rows (same id and vector) are one candidate and one query.
    * An empty table, or one without queries, gives no rows; fewer than ``k``
      candidates give fewer rows.
    """
    spark = vectors.sparkSession
    rows = written(
        vectors.select(
            col(id_col).cast("long").alias("vec_id"), col(vec_col).cast("array<double>").alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ).where(F.col("vec_id").isNotNull() & _usable(F.col("v"))).distinct(),
        "vectors",
    )
    # One row per distinct vector; only its k + 1 smallest ids can be answers.
    per_vector = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("v", "vec_id").distinct().select("*", F.row_number().over(per_vector).alias("n")).where(F.col("n") <= k + 1)
    index = written(few.groupBy("v").agg(F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "index")
    queries = rows.where("is_query").select("vec_id", "v")
    wanted = written(queries.groupBy("v").agg(F.min("vec_id").alias("first_id")), "queries")

    figures = index.agg(
        F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.max(F.size("v")), F.min(F.size("v"))
    ).first()
    count, square, width, narrow = figures
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if width != narrow:
        raise ValueError("vectors differ in length")
    reach = math.sqrt(square)
    # As many lists as vectors in a list, so that neither side of the search outgrows the other.
    lists = max(1, min(max_centroids, lists or math.ceil(math.sqrt(count))))
    # Chosen by hash below a threshold, so that all partitions together offer little more than the sample.
    wish, space = sample_per_list * lists, 1 << 30
    reached = F.pmod(F.xxhash64("v"), F.lit(space)) < min(space, math.ceil(space * (1.2 * wish + 500) / count))
    picked = index.select("v").where(reached).orderBy(F.xxhash64("v"), "v").limit(wish).collect()
    sample = np.array([r[0] for r in picked], dtype=np.float64)
    centroids = fit_centroids(_extended(sample, reach), lists)
    shared = spark.sparkContext.broadcast((centroids, link_centroids(centroids)))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vector, list): the nearest list and those nearly as near."""
        graph = CentroidGraph(*shared.value)
        for b in batches:
            vs = _matrix(b.column("v"))
            ids, at = [], []
            for i, x in zip(b.column("first_id").to_pylist(), _extended(vs, reach)):
                found = graph.nearest(x.astype(np.float32), replicas)
                for n, (d, c) in enumerate(found):
                    if n == 0 or d <= boundary * found[0][0]:
                        ids.append(i), at.append(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(at, pa.int32())], names=["first_id", "list"]
            )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(query, list): the lists that pass the distance-ratio rule."""
        graph = CentroidGraph(*shared.value)
        for b in batches:
            ids, at = [], []
            for i, x in zip(b.column("first_id").to_pylist(), _matrix(b.column("v"))):
                # The query's direction at full length lies on the sphere of the extended vectors.
                q = np.append(x * (reach / np.linalg.norm(x)), 0.0).astype(np.float32)
                found = graph.nearest(q, max_lists)
                near = found[0][0]
                for n, (d, c) in enumerate(found):
                    if n < min_lists or d <= ratio * near:
                        ids.append(i), at.append(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(at, pa.int32())], names=["first_id", "list"]
            )

    filed = written(index.select("first_id", "v").mapInArrow(file, "first_id long, list int"), "filed")
    asked = written(wanted.mapInArrow(choose, "first_id long, list int"), "asked")
    # Blocks per list; both tables have at most one row per centroid.
    blocks = (
        filed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("vb"))
        .join(asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qb")), "list")
    )
    blocks = F.broadcast(written(blocks, "blocks"))
    own = lambda n: F.pmod(F.xxhash64("first_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        filed.join(blocks, "list").join(index.select("first_id", "v"), "first_id")
        .select("list", "first_id", "v", own("vb").alias("vblock"), every("qb").alias("qblock"))
    )
    right = (
        asked.join(blocks, "list").join(wanted, "first_id")
        .select("list", "first_id", "v", own("qb").alias("qblock"), every("vb").alias("vblock"))
    )

    def compare(vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 nearest vectors of a block for every query of a block."""
        if not len(vs) or not len(qs):
            return no_rows("q", "ids", "scores")
        x, ids = np.stack(vs["v"].to_numpy()), vs["first_id"].to_numpy()
        out = []
        for lo in range(0, len(qs), 256):
            part = qs.iloc[lo : lo + 256]
            y = np.stack(part["v"].to_numpy())
            scores = y @ x.T
            keep = min(k + 1, len(ids))
            # Rows of equal score at the cut: all that reach the k + 1st score stay.
            cut = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
            slack = 1e-12 * (1.0 + np.abs(cut))
            at, j = np.nonzero(scores >= (cut - slack)[:, None])
            exact = (y[at] * x[j]).sum(axis=1)
            cuts = np.searchsorted(at, np.arange(1, len(part)))
            out.append(pd.DataFrame({"q": part["first_id"].to_numpy(), "ids": np.split(ids[j], cuts), "scores": np.split(exact, cuts)}))
        return pd.concat(out)

    keys = ["list", "vblock", "qblock"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "q long, ids array<long>, scores array<double>")
    # A replicated vector is found in several lists.
    found = best.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("q", F.col("x.ids").alias("first_id"), F.col("x.scores").alias("score")).distinct()
    nearest = Window.partitionBy("q").orderBy(F.col("score").desc(), "first_id")
    # k + 1 distinct vectors hold at least k answers besides the query itself.
    few = found.select("*", F.row_number().over(nearest).alias("n")).where(F.col("n") <= k + 1)
    named = few.join(index.select("first_id", "ids"), "first_id").select("q", "score", F.explode("ids").alias("vec_id"))
    top = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    named = written(named.select("*", F.row_number().over(top).alias("n")).where(F.col("n") <= k + 1), "answers")
    # Equal queries share the search; each leaves itself out.
    mates = queries.join(wanted.withColumnRenamed("first_id", "q"), "v").select("q", F.col("vec_id").alias("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        mates.join(named, "q").where("vec_id != query_id")
        .select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))


def _extended(v: np.ndarray, reach: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(reach**2 - (v**2).sum(axis=1), 0.0))
    return np.concatenate([v, rest[:, None]], axis=1)
