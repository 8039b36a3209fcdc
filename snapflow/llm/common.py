"""Helpers shared by the training-data operators."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapflow.session import scratch_path

# A word is a run of bytes other than ASCII white space.  For UTF-8 bytes this
# is what ``bytes.split()`` yields.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TIDY_S = 10  # seconds between two collections, at least
_tidied = [float("-inf")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name (dots and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def count_words(c: Column) -> Column:
    """Number of words; NULL counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage where its heap has grown past half of its limit.

    Spark drops the shuffle files and broadcasts of finished steps once the
    driver has collected their handles, and only a full collection lets the
    heap shrink again.  Chains of many steps ask for it between two of them,
    short steps not each time.
    """
    if time.monotonic() < _tidied[0] + TIDY_S:
        return
    java = spark.sparkContext._jvm.java.lang
    heap = java.Runtime.getRuntime()
    if 2 * heap.totalMemory() > heap.maxMemory():
        java.System.gc()
        _tidied[0] = time.monotonic()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (lineage ends here)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """An inner join that broadcasts neither side.

    Spark takes a table for the size of its files: it counts one row where ``explode`` makes many, one element in an
    array, and packed columns as they are packed.  Such a side may pass for small and be many times that on the driver.
    """
    return left.join(right.hint("merge"), on)


def global_rank(df: DataFrame, order: list[Column], rank: str, within: list[str] | None = None) -> DataFrame:
    """Append ``rank`` = 1-based position by ``order`` (within each ``within`` key).

    A plain window would put a whole key into one task.  Here rows are range
    partitioned by (key, order), written with the number of their range, and
    ranked inside it; the counts of the earlier ranges of the same key are
    added.  Only one row per (range, key) moves for that.
    """
    within = within or []
    keys = [col(k).asc_nulls_last() for k in within]
    ranged = df.repartitionByRange(*keys, *order).withColumn("_llm_part", F.spark_partition_id())
    ranged = written(ranged, "ranked")
    inside = Window.partitionBy("_llm_part", *within).orderBy(*order)
    ranked = ranged.withColumn("_llm_rn", F.row_number().over(inside).cast("long"))
    counts = ranged.groupBy("_llm_part", *within).agg(F.count(F.lit(1)).alias("_llm_n"))
    before = Window.partitionBy(*within).orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_llm_part").alias("_llm_p"),
        *[col(k).alias(f"_llm_k{i}") for i, k in enumerate(within)],
        F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_before"),
    )
    same = F.col("_llm_part") == F.col("_llm_p")
    for i, k in enumerate(within):
        same = same & col(k).eqNullSafe(F.col(f"_llm_k{i}"))
    return ranked.join(offsets, same).select(
        *[col(c) for c in df.columns], (F.col("_llm_rn") + F.col("_llm_before")).alias(rank)
    )
