"""Benchmark decontamination by spaced-seed hashing.

A seed mask selects some of the tokens of a short span and ignores the rest,
so a substituted token at an ignored place does not change the seed's hash.
Every position of every training text and of every benchmark item is hashed
under each mask; equal hashes are hits.  A hit fixes an alignment of item and
text, which is verified: within some window of ``window`` consecutive tokens
of the item (the whole item if shorter) at least ``share`` of the aligned
tokens agree.

The default masks meet every pattern of up to three substitutions in a window
of 16, so with ``share`` = 0.8 no such overlap is missed.  Items shorter than
the window have masks made for their length and the substitutions it allows
(``short_masks``); they meet every pattern of these too.  Both are shown by
enumeration in the tests.

Seeds are made by code-generated expressions over one array of tokens per
text; only hits leave the scan.  A hit takes along the tokens that its item is
laid over, never the whole text.  The seed table of the benchmark is broadcast
if it has at most ``broadcast_seeds`` rows, and joined by shuffle otherwise.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import col, written

MASKS = ("11010111", "111000001101")


def tokens(text: Column) -> Column:
    """Letters and digits, lower case; NULL gives an empty array."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(split, "")


def seeds(texts: DataFrame, key: str, masks: list[str]) -> DataFrame:
    """``key, at, seed`` of every position of the array column ``tokens`` under every mask."""
    shortest = min(len(m) for m in masks)
    at = texts.where(F.size("tokens") >= shortest).select(
        key, "tokens", F.size("tokens").alias("n"), F.explode(F.sequence(F.lit(0), F.size("tokens") - shortest)).alias("at")
    )
    hashed = []
    for mask in masks:
        chosen = [F.get("tokens", F.col("at") + i) for i, bit in enumerate(mask) if bit == "1"]
        hashed.append(F.when(F.col("at") + len(mask) <= F.col("n"), F.xxhash64(F.lit(mask), *chosen)))
    return at.select(key, "at", F.explode(F.array(*hashed)).alias("seed")).where(F.col("seed").isNotNull())


def short_masks(n: int, share: float) -> set[str]:
    """Masks that meet every allowed pattern of substitutions in an item of ``n`` tokens.

    ``wrong`` substitutions touch at most ``wrong`` of ``wrong + 2`` pieces of the item; for every choice of these the
    other pieces are a mask.
    """
    wrong = min(n - ceil(n * share), n - 1)
    pieces = min(wrong + 2, n)
    ends = [n * i // pieces for i in range(pieces + 1)]
    masks = set()
    for touched in combinations(range(pieces), wrong):
        masks.add("".join(("0" if i in touched else "1") * (ends[i + 1] - ends[i]) for i in range(pieces)).strip("0"))
    return masks


def _agreement(window: int, share: float) -> Column:
    """Whether some window of the item agrees with the text at offset ``shift``."""
    same = F.transform(
        F.sequence(F.lit(0), F.size("item") - 1),
        lambda j: F.when(F.get("tokens", j + F.col("shift")) == F.get("item", j), 1).otherwise(0),
    )
    width = F.least(F.lit(window), F.size("item"))
    # Running sums, so each window costs one subtraction.
    sums = F.aggregate(
        same,
        F.array(F.lit(0)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )
    return F.exists(
        F.sequence(F.lit(0), F.size("item") - width),
        lambda s: (F.get(F.col("sums"), s + width) - F.get(F.col("sums"), s)) >= F.ceil(width * F.lit(share)),
    ), sums


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    masks: tuple[str, ...] = MASKS,
    window: int = 16,
    share: float = 0.8,
    broadcast_seeds: int = 2_000_000,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Verified overlaps: ``text_hash, item_id``, a row per pair of a text and an item.

    ``text_hash`` is ``xxhash64(text)``: equal texts are judged once.
    """
    items = written(
        benchmark.select(col(item_col).alias("item_id"), tokens(col(item_text_col)).alias("tokens")).where(F.size("tokens") > 0),
        "benchmark",
    )
    # Fewer lengths than the window has tokens.
    short = [r[0] for r in items.where(F.size("tokens") < window).select(F.size("tokens")).distinct().collect()]
    numbered = items.withColumn("item_key", F.xxhash64("item_id", F.concat_ws(" ", "tokens")))
    marks = seeds(numbered.where(F.size("tokens") >= window), "item_key", list(masks))
    tried_masks = set(masks)
    for n in sorted(short):
        own = short_masks(n, share)
        marks = marks.union(seeds(numbered.where(F.size("tokens") == n), "item_key", sorted(own)))
        tried_masks |= own
    lengths = numbered.select("item_key", F.size("tokens").alias("item_n")).distinct()
    marks = marks.select("item_key", F.col("at").alias("item_at"), "seed").distinct().join(lengths, "item_key")
    marks = written(marks, "benchmark-seeds")
    few = marks.count() <= broadcast_seeds

    texts = docs.select(F.xxhash64(col(text_col)).alias("text_hash"), tokens(col(text_col)).alias("tokens"))
    tried = seeds(texts, "text_hash", sorted(tried_masks))
    hits = tried.join(F.broadcast(marks) if few else marks, "seed")
    hits = written(hits.select("text_hash", "item_key", "item_n", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")

    # Only texts with a hit are read again.
    held = docs.select(F.xxhash64(col(text_col)).alias("text_hash"), col(text_col).alias("text"))
    held = held.join(hits.select("text_hash").distinct(), "text_hash", "left_semi")
    held = held.groupBy("text_hash").agg(F.min("text").alias("text")).select("text_hash", tokens(F.col("text")).alias("tokens"))
    agrees, sums = _agreement(window, share)
    # The span under the item; an item that begins before the text keeps a negative shift.
    before = F.least("shift", F.lit(0))
    span = F.slice("tokens", F.greatest("shift", F.lit(0)) + 1, F.col("item_n") + before)
    spans = hits.join(held, "text_hash").select("text_hash", "item_key", before.alias("shift"), span.alias("tokens"))
    aligned = spans.distinct().join(
        numbered.select("item_key", "item_id", F.col("tokens").alias("item")).distinct(), "item_key"
    )
    return aligned.withColumn("sums", sums).where(agrees).select("text_hash", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, contaminated, item_ids`` (ascending).

    * A NULL or empty text, or one without letters and digits, is clean; such
      items match nothing.  A NULL item id is reported as matching, with no id.
    * Repeated rows get a row each; equal texts get the same verdict.
    * Other columns are not read.  Empty tables give no rows, or clean rows.
    """
    found = overlaps(docs, benchmark, text_col=text_col, **options)
    verdict = found.groupBy(F.col("text_hash").alias("_hash")).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    rows = docs.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("_text"))
    joined = rows.join(verdict, F.col("_text") == F.col("_hash"), "left")
    return joined.select(
        "doc_id",
        F.col("_hash").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast(found.select(F.array("item_id")).schema[0].dataType)).alias("item_ids"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an overlap, all columns unchanged."""
    found = overlaps(docs, benchmark, text_col=text_col, **options).select("text_hash").distinct()
    return docs.join(found, F.xxhash64(col(text_col)) == F.col("text_hash"), "left_anti").select(*[col(c) for c in docs.columns])
