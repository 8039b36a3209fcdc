"""Mixing sources to target weights by systematic sampling.

The budget (``budget`` x all words) is shared among the sources by weight; a
source's target stops at ``max_repeat`` x its own words and the excess is
reshared by weight among the others until none is above.  Every document of a
source then expects ``target / source_size`` copies.  The expected copies are
prefix-summed over the source's documents, ordered by size, one offset in
[0, 1) drawn for the source is added, and a document is emitted once per
integer boundary that its stretch of the line crosses.

Ordering by size spreads the extra copies evenly over short and long
documents, so the words taken stay near the target.  Because the expected
copies are equal within a source, the prefix sum is rank x rate, and ranks are
computed over range partitions (``global_rank``), never with a whole source
in one task.  All draws are hashes: reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import col, count_words, global_rank, written


def hash_unit(text: Column) -> Column:
    """A number in [0, 1) from a text, the same on every run (and in plain SQL)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def cyclic_weights(weights: list[float]) -> Callable[[Column], Column]:
    """Weight of a source from its 1-based rank: the list, repeating."""
    return lambda rank: F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (((rank - 1) % len(weights)) + 1).cast("int")
    )


def source_targets(
    sizes: DataFrame, budget: float, max_repeat: float, weight_of: Callable[[Column], Column]
) -> DataFrame:
    """Per source: ``source, source_size, target``.  ``sizes`` has one row per source.

    Each pass reshares what the capped sources leave; only the pass's two
    totals reach the driver.
    """
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], "rank")
    base = written(
        ranked.select(
            "source",
            "source_size",
            weight_of(F.col("rank")).alias("weight"),
            (F.col("source_size") * F.lit(float(max_repeat))).alias("cap"),
        ),
        "sources",
    )
    total = base.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while True:
        over = F.col("cap") < F.lit(share) * F.col("weight")
        row = base.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.count_if(over),
        ).first()
        if row[2] is None or row[2] == capped or not row[1]:
            break
        capped = row[2]
        share = (budget * total - (row[0] or 0.0)) / row[1]
    return base.select(
        "source", "source_size", F.least(F.col("cap"), F.lit(share) * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    *,
    budget: float = 1.5,
    max_repeat: float = 2.0,
    weight_of: Callable[[Column], Column] | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies, taken``.

    * NULL or empty text has size 0: it takes no words, whatever its copies.
    * NULL source is a source of its own and ranks last.
    * A source without words has target 0 and its rows get 0 copies.
    * Repeated rows are separate documents; ties in size are ordered by a hash
      of doc_id, then doc_id (NULL first), so equal rows may swap places only
      with each other.
    * Other columns of ``docs`` are not read.  An empty table gives no rows.
    """
    weight_of = weight_of or cyclic_weights([5, 2, 1])
    sized = docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"), count_words(col(text_col)).alias("size")
    )
    sized = sized.withColumn("order_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))))
    ranked = written(
        global_rank(
            sized,
            [F.col("size").asc(), F.col("order_key").asc(), F.col("doc_id").asc_nulls_first()],
            "rank",
            within=["source"],
        ),
        "sized",
    )
    sizes = ranked.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, budget, max_repeat, weight_of).withColumnRenamed("source", "_llm_source")
    joined = ranked.join(targets, F.col("source").eqNullSafe(F.col("_llm_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hash_unit(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("\x00null"))))
    crossed = lambda rank: F.floor(rank * rate + offset)
    copies = (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).cast("long")
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def emit_copies(docs: DataFrame, mixed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: each row of ``docs`` once per copy, with ``copy`` counting from 1.

    Rows equal in doc_id, source and size are interchangeable for ``mix``;
    they are paired one to one by a running number, so none is multiplied.
    """
    twins = ["_llm_id", "_llm_source", "_llm_size"]
    numbered = Window.partitionBy(*twins)
    taken = mixed.where("copies > 0").select(
        F.col("doc_id").alias("_llm_id"),
        F.col("source").alias("_llm_source"),
        F.col("size").alias("_llm_size"),
        F.col("copies").cast("int").alias("_llm_copies"),
    )
    taken = taken.select("*", F.row_number().over(numbered.orderBy(F.col("_llm_copies").desc())).alias("_llm_twin"))
    rows = docs.select(
        "*",
        col(id_col).alias("_llm_id"),
        col(source_col).alias("_llm_source"),
        count_words(col(text_col)).alias("_llm_size"),
    )
    rows = rows.select("*", F.row_number().over(numbered.orderBy(col(text_col))).alias("_llm_twin"))
    same = F.lit(True)
    for name in [*twins, "_llm_twin"]:
        same = same & rows[name].eqNullSafe(taken[name])
    return rows.join(taken, same).select(
        *[rows[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_llm_copies"))).alias("copy")
    )
