"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

Every stage's result is written as Parquet and read again by the next, so a
lost executor costs at most the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from snapflow.llm.common import table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines one stays; documents left without any line go.  ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs, width=3, max_bits=2)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: the columns of documents and ``copy`` (from 1)."""
    mixed = mixing.mix(docs, budget=1.5, max_repeat=2.0, weight_of=mixing.cyclic_weights([5, 2, 1]))
    return mixing.emit_copies(docs, mixed)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate_documents),
    ("source_mixing", mix_sources),
]

# Trained weights, MinHash and 64-bit fingerprints are beyond SQL; the stages
# are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
