"""SimHash near-duplicates by anchor-point covering.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the hashes
(XXH64, seed 42) of the text's word shingles.

Search: the anchors are the codewords of a covering code, here the perfect
[31, 26] Hamming code on bits 0-30 and on bits 32-62 of the fingerprint.  Its
covering radius is 1: every half is within 1 bit of exactly one anchor, its
home.  Two fingerprints that differ in at most t bits differ in at most
t // 2 bits in one of the halves, so there the other one lies within
1 + t // 2 of the first one's home.  Each fingerprint is therefore replicated
to every anchor within covering radius plus threshold (17 per half for t = 2)
and compared, per anchor, with those at home there.

An anchor where more than ``crowd`` fingerprints are at home would compare too
many pairs.  The fingerprints around such anchors take an exact detour with
linear work: each is replicated to all points within t / 2 bits of itself, and
fingerprints that share a point are linked through the smallest of them.  For
an even t that is the same link relation (two balls of radius t / 2 meet if
and only if the centres differ in at most t bits).

Equal fingerprints are one before the search; links are joined into
components by distributed union-find.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import col, shuffled_join, written
from snapflow.llm.components import connected_components

BITS = 31  # code length of each half
CHUNK = 1 << 16  # shingles hashed at a time


def fingerprint(text: str | None, width: int) -> int:
    """The fingerprint as a signed 64-bit integer; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], 0
    for w in words:
        at += len(w)
        ends.append(at)
        at += 1
    n = max(1, len(words) - width + 1)
    last = min(width, len(words)) - 1
    counts, start, h = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    for lo in range(0, n, CHUNK):
        hashes = []
        for end in ends[lo + last : min(lo + CHUNK, n) + last]:
            hashes.append(h(joined[start:end], 42))
            start = ends[lo + len(hashes) - 1] + 1
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` (signed 64-bit) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x.as_py(), width) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], schema=schema)

    text = col(text_col)
    return docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, "doc_id long, text_hash long, fp long"
    )


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def error_patterns(radius: int) -> list[list[int]]:
    """By syndrome (0..31): the flips of at most ``radius`` of 31 bits that lead to a codeword."""
    out: list[list[int]] = [[] for _ in range(BITS + 1)]
    for weight in range(radius + 1):
        for places in combinations(range(1, BITS + 1), weight):
            syndrome, mask = 0, 0
            for p in places:
                syndrome ^= p
                mask |= 1 << (p - 1)
            out[syndrome].append(mask)
    return out


def _syndrome(half: Column) -> Column:
    """Of the Hamming code whose parity checks are the binary place numbers 1..31."""
    value = F.lit(0)
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, BITS + 1) if p >> j & 1)
        parity = F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))).bitwiseAND(F.lit(1))
        value = value + F.shiftleft(parity, j)
    return value


def anchors(fps: DataFrame, radius: int) -> DataFrame:
    """``fp, anchor`` for every anchor within ``radius`` of either half of ``fp``."""
    table = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in error_patterns(radius)])
    low = F.lit((1 << BITS) - 1).cast("long")
    halves = fps.select(
        "fp",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("side"), F.col("fp").bitwiseAND(low).alias("half")),
                F.struct(F.lit(1 << 40).cast("long").alias("side"), F.shiftrightunsigned("fp", 32).bitwiseAND(low).alias("half")),
            )
        ).alias("h"),
    ).select("fp", "h.side", "h.half")
    masks = halves.select("fp", "side", "half", F.explode(F.element_at(table, _syndrome(F.col("half")) + 1)).alias("mask"))
    return masks.select("fp", F.col("half").bitwiseXOR(F.col("mask")).bitwiseOR(F.col("side")).alias("anchor"))


def _ball_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links of all fingerprints within 2 x ``radius`` bits, through shared points."""
    masks = [0] + [sum(1 << p for p in c) for k in range(1, radius + 1) for c in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    points = fps.select(
        "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("long")) for m in signed])).alias("point")
    )
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return shuffled_join(points, least, "point").where("fp != a").select("a", F.col("fp").alias("b"))


def links(fps: DataFrame, max_bits: int, crowd: int) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect all within ``max_bits``."""
    if max_bits % 2 or not 0 < max_bits <= 6:
        raise ValueError("max_bits is 2, 4 or 6")
    home = written(anchors(fps, 1), "home")
    reach = anchors(fps, 1 + max_bits // 2)
    counts = written(home.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "anchors")
    quiet = shuffled_join(home, counts.where(F.col("n") <= crowd), "anchor").select(F.col("anchor"), F.col("fp").alias("a"))
    compared = (
        shuffled_join(reach.withColumnRenamed("fp", "b"), quiet, "anchor")
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
        .select("a", "b")
    )
    around = reach.join(counts.where(F.col("n") > crowd), "anchor", "left_semi").select("fp").distinct()
    return compared.union(_ball_links(written(around, "crowded"), max_bits // 2))


def _grouped(docs: DataFrame, width: int, max_bits: int, crowd: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Every row's fingerprint, and each fingerprint's component (both written)."""
    marked = written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    distinct = written(marked.select("fp").distinct(), "distinct-fingerprints")
    parts = connected_components(links(distinct, max_bits, crowd))
    grouped = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )
    return marked, written(grouped, "components")


def near_duplicates(
    docs: DataFrame,
    *,
    width: int = 3,
    max_bits: int = 2,
    crowd: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id of the component.

    * NULL text counts as empty; texts without words have fingerprint 0 and
      are linked like any other.
    * Fewer words than ``width`` make one shingle of the whole sequence.
    * A NULL doc_id takes part but never names a component; a component of
      NULL ids only has a NULL component_id.
    * Repeated rows get a row each.  Other columns are not read.  An empty
      table gives no rows.
    """
    marked, grouped = _grouped(docs, width, max_bits, crowd, id_col, text_col)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")).join(grouped, "fp")
    named = least.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = grouped.join(named, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, *, width: int = 3, max_bits: int = 2, crowd: int = 64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, all columns unchanged: that with the smallest
    doc_id (NULL largest), of equal ids with the smallest text hash, of equal
    rows any one."""
    marked, grouped = _grouped(docs, width, max_bits, crowd, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    least = marked.groupBy("fp").agg(F.min(order).alias("first")).join(grouped, "fp")
    kept = least.groupBy("component").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("_llm_id"), F.col("first.text_hash").alias("_llm_hash"))
    same = (F.xxhash64(col(text_col)) == F.col("_llm_hash")) & col(id_col).cast("long").eqNullSafe(F.col("_llm_id"))
    twins = Window.partitionBy("_llm_hash", "_llm_id").orderBy("_llm_hash")
    joined = docs.join(kept, same).withColumn("_llm_twin", F.row_number().over(twins))
    return joined.where("_llm_twin = 1").select(*[col(c) for c in docs.columns])
