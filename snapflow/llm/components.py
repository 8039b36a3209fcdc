"""Connected components of a link table by repeated star contraction.

A distributed union-find: each round points every node's larger neighbours at
its smallest neighbour (large star), then every node's smaller neighbours at
the smallest of them (small star).  The table ends as (node, root) stars after
a number of rounds that grows with the logarithm of the longest chain.  Each
round groups by node with partial minima and joins these back, so a node with
very many links is neither collected nor pinned to one task (a skewed side is
split by adaptive execution); each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import written


def _summary(links: DataFrame) -> tuple:
    """Count and order-free checksum of a link table."""
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links come as (larger, smaller)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return (
        links.join(least, "a")
        .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        .where("a != b")
    )


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node with a link.

    ``links`` holds pairs of one orderable type in any direction; repeated
    pairs and self links are allowed, rows with a NULL end are no links.  No
    links give no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
    current = written(pairs.where("x is not null and y is not null and a != b").select("a", "b").distinct(), "links")
    before = _summary(current)
    while before[0]:
        current = written(_small_star(_large_star(current).distinct()).distinct(), "links")
        now = _summary(current)
        if now == before:
            break
        before = now
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)
