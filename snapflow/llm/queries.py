"""The registered queries of this subpackage: thin, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import (
    ann,
    arc_warc,
    chat_format,
    collocations,
    decontaminate,
    line_dedup,
    mixing,
    ngram_lm,
    norm_buckets,
    sentence_pieces,
    simhash,
    substring_dedup,
    toxicity,
)
from snapflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def arc_to_warc(spark: SparkSession, d: str) -> DataFrame:
    read = arc_warc.pages_to_warc(table(spark, d, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def posting_list_ann(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def simhash_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), width=3, max_bits=2)


def systematic_mix(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(table(spark, d, "documents"), budget=1.5, max_repeat=2.0, weight_of=mixing.cyclic_weights([5, 2, 1]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def prefix_target_chat(spark: SparkSession, d: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat_format.digests(chat_format.expand(turns)).drop("n_examples")


def minhash_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, d, "documents"))


def spaced_seed_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))


def counterfactual_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"), threshold=0.7)


def deleted_interpolation_lm(spark: SparkSession, d: str) -> DataFrame:
    return ngram_lm.score_texts(table(spark, d, "documents"))


def automaton_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, d, "documents"), window=35).drop("kept")


def sentencepiece_round_trip(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    read = sentence_pieces.round_trip(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def norm_bucket_search(spark: SparkSession, d: str) -> DataFrame:
    return norm_buckets.search(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


def misra_gries_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.mine(table(spark, d, "documents"), least=10, cover_percent=50, top=2000)


LLM_QUERIES: dict[str, Query] = {
    "op1_minhash_line_dedup": minhash_line_dedup,
    "op2_spaced_seed_decontamination": spaced_seed_decontamination,
    "op3_arc_to_warc": arc_to_warc,
    "op4_posting_list_ann": posting_list_ann,
    "op5_simhash_near_duplicates": simhash_near_duplicates,
    "op6_systematic_mix": systematic_mix,
    "op7_counterfactual_toxicity": counterfactual_toxicity,
    "op8_deleted_interpolation_lm": deleted_interpolation_lm,
    "op9_prefix_target_chat": prefix_target_chat,
    "op10_automaton_substring_dedup": automaton_substring_dedup,
    "op11_sentencepiece_rounds": sentencepiece_round_trip,
    "op12_norm_bucket_search": norm_bucket_search,
    "op13_misra_gries_collocations": misra_gries_collocations,
}
