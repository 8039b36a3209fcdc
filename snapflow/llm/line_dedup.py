"""Fuzzy line dedup by MinHash.

Distinct lines are cut into character shingles (over UTF-16 code units, so a
shingle is a slice of constant cost).  One hash per shingle serves a one
permutation MinHash: the hash picks a bin, and each bin keeps its minimum.
``bands`` keys of ``rows`` bins each make high-recall buckets.  Pairs are
verified by their exact Jaccard similarity of shingle sets, and a distributed
union-find joins the verified links.

The result is that of all pairs of every bucket.  First every line of a bucket
is compared with a leader, and the lines left out choose a leader among
themselves while leaders take a fair part of their bucket: this joins large
families with one pair per line.  Then the pairs of a bucket that are in
different components are looked at, block by block, so no task holds a bucket.

Before any text is read for a pair, two exact bounds are asked: the set sizes,
and the parity bits of the sets.  Each shingle flips one of ``64 * WORDS`` bits
of its line, so two lines differ in at least as many shingles as bits, and a
similarity of 0.8 allows a ninth of both sets to differ.  Lines of one template
that differ in more than that never leave the join: only the few words of a
block's pairs are compared for them, and its rows grow with the lines.

Of each component, exact copies included, the first line by (doc_id, line
number, text hash) stays.

Everything is a DataFrame expression.  The text is shuffled once, to find the
distinct lines; later steps move line ids (64-bit hashes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import col, shuffled_join, written
from snapflow.llm.components import connected_components


BROADCAST_ROWS = 250_000  # of one or two numbers each
WORDS = 16  # of 64 parity bits
MEASURES = ["n", "parity"]  # size and parity bits (an array of words) of a line's set
BLOCK = 64  # lines of a bucket per block
FAIR = 8  # a leader that takes less than 1/FAIR of its bucket is the bucket's last


def _wide(line: Column) -> Column:
    return F.encode(line, "UTF-16BE")


def _shingles(wide: str, size: int) -> Column:
    """The hashes of a line's shingles.

    The line goes through a lambda of its own: named inside the inner one, a column of bytes is copied whole for
    every shingle.
    """
    of = lambda w: F.transform(F.sequence(F.lit(0), (F.length(w) / 2).cast("int") - size), lambda i: _shingle(w, i, size))
    return F.element_at(F.transform(F.array(wide), of), 1)


def _shingle(wide: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.substring(wide, i * 2 + 1, F.lit(2 * size)))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table behind a check of its size; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, line_no, line, id`` of every line that is not blank."""
    rows = docs.select(
        col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("text_hash"),
        F.posexplode(F.split(col(text_col), "\n")).alias("line_no", "line"),
    )
    return rows.where(F.col("line").rlike(r"\S")).withColumn("id", F.xxhash64("line"))


def band_keys(lines: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``id, keys``: the band keys of each line of at least ``size`` characters.

    ``lines`` is hash partitioned by ``id`` already, so the minima need no shuffle.
    """
    bins = bands * rows
    wide = lines.select("id", _wide(F.col("line")).alias("wide")).where(F.length("wide") >= 2 * size)
    each = F.explode(F.sequence(F.lit(0), (F.length("wide") / 2).cast("int") - size)).alias("i")
    shingles = wide.select("id", "wide", each).select("id", _shingle(F.col("wide"), F.col("i"), size).alias("h"))
    placed = shingles.withColumn("bin", F.pmod("h", F.lit(bins)).cast("int"))
    placed = placed.select("id", "h", F.expr(f"cast(bin div {rows} as int)").alias("b"), (F.col("bin") % rows).alias("j"))
    # First one row per (line, band), then one per line: cheaper than all bins' minima in one row.
    least = placed.groupBy("id", "b").agg(*[F.min(F.when(F.col("j") == j, F.col("h"))).alias(f"m{j}") for j in range(rows)])
    # An empty bin counts as equal to an empty bin; a band of empty bins has no row.
    filled = [F.coalesce(f"m{j}", F.lit(-1).cast("long")) for j in range(rows)]
    keyed = least.select("id", "b", F.xxhash64("b", *filled).alias("key"))
    keys = keyed.groupBy("id").agg(*[F.max(F.when(F.col("b") == b, F.col("key"))).alias(f"k{b}") for b in range(bands)])
    return keys.select("id", F.array_compact(F.array(*[f"k{b}" for b in range(bands)])).alias("keys"))


def verified(pairs: DataFrame, lines: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of line ids whose shingle sets, of ``na`` and ``nb``, are similar enough.  ``lines``: ``id, wide``."""
    text = lambda name: lines.select(F.col("id").alias(name), F.col("wide").alias(f"{name}_wide"))
    both = pairs.join(text("a"), "a").join(text("b"), "b")
    shared = F.size(F.array_intersect(_shingles("a_wide", size), _shingles("b_wide", size)))
    # Generated, so that it is made once however often it is used below.
    sets = both.select("a", "b", "na", "nb", F.explode(F.array(shared)).alias("shared"))
    return sets.where(F.col("shared") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def measures(texts: DataFrame, size: int) -> DataFrame:
    """``id`` and ``MEASURES`` of the lines in ``texts`` (``id, wide``); the shingles are combined where they are made."""
    each = texts.select("id", F.explode(F.array_distinct(_shingles("wide", size))).alias("h"))
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    word = F.shiftrightunsigned("h", 6).bitwiseAND(WORDS - 1)
    parity = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"p{k}") for k in range(WORDS)]
    found = each.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("n"), *parity)
    return found.select("id", "n", F.array(*[f"p{k}" for k in range(WORDS)]).alias("parity"))


def possible(x: str, y: str, similarity: float) -> Column:
    """False only if the measures of two lines (columns with these prefixes) rule the similarity out."""
    own = lambda side, c: F.col(f"{side}{c}")
    nx, ny = own(x, "n"), own(y, "n")
    word = lambda side, k: F.get(own(side, "parity"), F.lit(k))
    differing = sum((F.bit_count(word(x, k).bitwiseXOR(word(y, k))) for k in range(WORDS)), F.lit(0))
    allowed = F.lit((1 - similarity) / (1 + similarity)) * (nx + ny) + F.lit(1e-6)
    return (F.least(nx, ny) >= F.lit(similarity) * F.greatest(nx, ny)) & (differing <= allowed)


def open_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """``a, b, na, nb``: the pairs of each bucket that are in different parts and whose measures allow the similarity.

    ``members``: ``band, id, part`` and ``MEASURES``.  A bucket is cut into blocks and every two blocks meet under a
    key of their own.
    """
    buckets = members.groupBy("band").agg(F.count(F.lit(1)).alias("lines"), F.min("part").alias("p"), F.max("part").alias("q"))
    buckets = buckets.where("p != q").select("band", F.ceil(F.col("lines") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(buckets, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    side = lambda i: [F.col(c).alias(f"{i}{c}") for c in ("id", "part", *MEASURES)]
    x = placed.select("band", *side("x_"), F.col("block").alias("u"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("v"))
    y = placed.select("band", *side("y_"), F.explode(F.sequence(F.lit(0), "block")).alias("u"), F.col("block").alias("v"))
    once = F.expr("x_part != y_part and (u < v or x_id < y_id)")
    pairs = x.join(y, ["band", "u", "v"]).where(once & possible("x_", "y_", similarity))
    return _ordered(pairs, "x_id", "y_id", "x_n", "y_n").distinct()


def _ordered(pairs: DataFrame, x: str, y: str, nx: str, ny: str) -> DataFrame:
    """``a, b, na, nb``: the smaller id first."""
    turned = F.col(x) > F.col(y)
    pick = lambda first, second: F.when(turned, F.col(second)).otherwise(F.col(first))
    return pairs.select(pick(x, y).alias("a"), pick(y, x).alias("b"), pick(nx, ny).alias("na"), pick(ny, nx).alias("nb"))


def similar_lines(
    keys: DataFrame, lines: DataFrame, *, size: int, similarity: float
) -> DataFrame:
    """``node, component`` of the lines that have a similar other line.

    ``keys``: band keys per line id; ``lines``: ``id, line``, repeats allowed.
    """
    entries = keys.select("id", F.explode("keys").alias("band"))
    counts = entries.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    crowded = written(counts, "crowded-bands")
    few = crowded.count() <= BROADCAST_ROWS
    shared = entries.join(F.broadcast(crowded), "band") if few else shuffled_join(entries, crowded, "band")
    shared = written(shared, "shared-bands")
    ids = written(shared.select("id").distinct(), "candidate-ids")
    candidates = lines.join(_small(ids), "id", "left_semi")
    texts = candidates.groupBy("id").agg(F.min("line").alias("line")).select("id", _wide(F.col("line")).alias("wide"))
    texts = written(texts, "candidates")
    members = written(shuffled_join(shared, measures(texts, size), "id"), "members")  # band, id and measures

    open_, links, compared = members, None, None
    turn = 0
    while True:
        # Every bucket has an order of its own: a line that shares several buckets meets several leaders.
        order = F.xxhash64(F.col("band"), F.lit(turn), F.col("id"))
        leaders = open_.groupBy("band").agg(F.min(F.struct(order.alias("o"), F.col("id").alias("leader"), *MEASURES)).alias("first"))
        leaders = leaders.select("band", "first.leader", *[F.col(f"first.{m}").alias(f"l_{m}") for m in MEASURES])
        led = open_.join(leaders, "band").where("id != leader")
        led = led.withColumns({"a": F.least("id", "leader"), "b": F.greatest("id", "leader"), "maybe": possible("", "l_", similarity)})
        led = written(led.drop("l_parity"), "led")
        pairs = _ordered(led.where("maybe"), "id", "leader", "n", "l_n").distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(verified(pairs, texts, size, similarity), "links")
        # No pair comes twice, so the tables of all rounds are read as they are.
        seen = pairs.select("a", "b")
        compared = seen if compared is None else compared.union(seen)
        links = found if links is None else links.union(found)
        # Lines that their leader left out lead one another in the next round, in buckets whose leader took a fair part.
        out = led.join(links.withColumn("linked", F.lit(True)), ["a", "b"], "left")
        fair = out.groupBy("band").agg(F.count(F.lit(1)).alias("all"), F.count("linked").alias("taken"))
        fair = fair.where((F.col("taken") * FAIR >= F.col("all")) & (F.col("all") - F.col("taken") > FAIR)).select("band")
        open_ = written(out.where("linked is null").join(fair, "band", "left_semi").select("band", "id", *MEASURES), "left-out")
        if open_.isEmpty():
            break
        turn += 1

    parts = written(connected_components(links), "parts")
    placed = members.join(parts.withColumnRenamed("node", "id"), "id", "left")
    placed = written(placed.select("band", "id", F.coalesce("component", "id").alias("part"), *MEASURES), "placed")
    pairs = written(open_pairs(placed, similarity).join(compared, ["a", "b"], "left_anti"), "open-pairs")
    found = written(verified(pairs, texts, size, similarity), "open-links")
    if found.isEmpty():
        return parts
    joined = parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found)
    return connected_components(joined)


def line_verdicts(
    docs: DataFrame,
    *,
    size: int = 8,
    similarity: float = 0.8,
    bands: int = 10,
    rows: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Lines to remove: ``doc_id, text_hash, removed`` (line numbers from 0), for documents that lose any."""
    found = occurrences(docs, id_col, text_col)
    # One shuffle of the text: distinct lines, and on the same partitioning their band keys.
    distinct = found.groupBy("id").agg(
        F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first"), F.count(F.lit(1)).alias("n"), F.min("line").alias("line")
    )
    keyed = distinct.select("id", "first", "n").join(band_keys(distinct.select("id", "line"), size, bands, rows), "id", "left")
    lines = written(keyed, "lines")
    text = docs.select(F.explode(F.split(col(text_col), "\n")).alias("line")).select(F.xxhash64("line").alias("id"), "line")
    parts = similar_lines(lines.where("keys is not null").select("id", "keys"), text, size=size, similarity=similarity)
    grouped = lines.select("id", "first", "n").join(parts.withColumnRenamed("node", "id"), "id", "left")
    grouped = grouped.where("n > 1 or component is not null").select(
        "id", "first", F.coalesce("component", "id").alias("part")
    )
    kept = grouped.groupBy("part").agg(F.min("first").alias("kept"))
    verdict = grouped.join(kept, "part").select("id", "kept")
    where = found.select("doc_id", "text_hash", "line_no", "id").join(verdict, "id")
    gone = where.where(~F.struct("doc_id", "line_no", "text_hash").eqNullSafe(F.col("kept")))
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def _with_verdicts(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    verdicts = written(line_verdicts(docs, id_col=id_col, text_col=text_col, **options), "line-verdicts")
    figures = verdicts.agg(F.count(F.lit(1)), F.sum(F.size("removed"))).first()
    few = figures[0] + (figures[1] or 0) <= 4 * BROADCAST_ROWS  # single numbers, up to a few MB
    verdicts = F.broadcast(verdicts) if few else verdicts
    named = verdicts.select(F.col("doc_id").alias("_llm_id"), F.col("text_hash").alias("_llm_hash"), F.col("removed").alias("_llm_removed"))
    same = (F.xxhash64(col(text_col)) == F.col("_llm_hash")) & col(id_col).eqNullSafe(F.col("_llm_id"))
    return docs.join(named, same, "left")


def dedup_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, removed`` (line numbers from 0, ascending).

    * Of similar lines, exact copies included, the one with the smallest
      (doc_id, line number) stays; a NULL doc_id is smallest.  Where one doc_id
      has several texts the text's hash decides between them.
    * Blank lines are neither compared nor removed; lines shorter than a
      shingle are compared exactly.  A NULL text has no lines, an empty one a
      blank line.
    * Rows of one doc_id and one text stand for one document: both keep what
      the first occurrence keeps.  Other columns are not read.
    * An empty table gives no rows.
    """
    rows = docs.select(
        col(id_col).alias("doc_id"), col(text_col).isNull().alias("none"), F.xxhash64(col(text_col)).alias("text_hash"),
        F.size(F.split(col(text_col), "\n")).cast("long").alias("n"),
    )
    verdicts = line_verdicts(docs, id_col=id_col, text_col=text_col, **options).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "removed"
    )
    joined = rows.join(verdicts, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select(
        "doc_id",
        F.when(F.col("none"), F.lit(0).cast("long")).otherwise(F.col("n")).alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
    )


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their removed lines, all columns kept.

    A document that loses every line with any text in it is dropped; all
    others stay, empty and NULL texts included.
    """
    joined = _with_verdicts(docs, id_col, text_col, options)
    left = F.array_join(
        F.filter(F.split(col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col("_llm_removed"), i)), "\n"
    )
    text = F.when(F.col("_llm_removed").isNull(), col(text_col)).otherwise(left)
    marked = joined.withColumn("_llm_text", text).where(F.col("_llm_removed").isNull() | F.col("_llm_text").rlike(r"\S"))
    return marked.select(*[(F.col("_llm_text") if c == text_col else col(c)).alias(c) for c in docs.columns])
