"""Phrase collocation mining with Misra-Gries summaries.

Phrases are two or three words of one piece of a text, counted per language.
Only phrases with at least ``least`` occurrences are candidates, a small share
of all that occur:

1. Tasks cut texts into words and count the words, then the pairs, then the
   triples of a chunk of documents.  A phrase is the 64-bit hashes of its words
   (a word's hash covers its language).  A chunk's counts are a summary from
   which nothing was taken, so a phrase that a third of all rows hold moves as
   one row per chunk.
2. Pairs with a rare word and triples with a rare pair are left out, as they
   are rare themselves.  Tasks tell by a filter of ``FILTER_BITS`` bits: its
   size is fixed, and where it is full it lets rare ones pass, which costs time
   only.
3. Phrases are dealt out to hash partitions of about ``PARTITION_MASS``
   occurrences.  Each partition merges the chunks' counts into one Misra-Gries
   summary: beyond its capacity the count of the next largest is taken from
   all.  Its capacity exceeds the partition's mass divided by ``least``, so
   less than ``least`` is taken in all and every candidate survives.  Should
   the hash deal a partition more than its share, its capacity grows before
   that much is taken.
4. The second pass reads the same exchange again (Spark reuses it), keeps the
   survivors' rows and counts them exactly.
5. Words, the counts of a candidate's parts and the longer candidates around
   it are joined by hash.  Products are 38-digit decimals.

Exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.blocks import mixed, release
from snapflow.llm.common import col, global_rank, written

# The characters that end a piece and those between words.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
FOLDED = bytes(
    10 if c in PIECE_ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)  # ends become line feeds, blanks spaces, A-Z small

CHUNK_WORDS = 1_000_000
PARTITION_MASS = 10_000_000  # phrase occurrences of a hash partition, at most about
FILTER_BITS = 1 << 27  # 16 MB
GRAM = ["h1", "h2", "h3"]


def cut(text: str | None) -> list[bytes]:
    """Words in order, a line feed at the end of each piece, and empty strings to skip."""
    return (text or "").encode().translate(FOLDED).replace(b"\n", b" \n ").split(b" ")


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh32_intdigest(lang.encode()))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).alias("text"))


def count_words(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """``h, lang, word, n`` of every word of a language."""
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)

        def flush() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, words in found.items() for w, n in words.items()]
            found.clear()
            h = np.array([word_hash(lang, w) for lang, w, _ in rows], np.uint64).view(np.int64)
            columns = [h, [r[0] for r in rows], [r[1].decode() for r in rows], [r[2] for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = found[lang]
                words.update(cut(text.as_py()))
                words.pop(b"", None), words.pop(b"\n", None)
                if len(words) > CHUNK_WORDS // 4:
                    yield flush()
        yield flush()
        release()

    rows = _texts(docs, lang_col, text_col).mapInArrow(run, "h long, lang string, word string, n long")
    return rows.groupBy("h").agg(F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("n").alias("n"))


def phrase_key(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of the hashes of a phrase's words."""
    key = mixed(parts[0].view(np.uint64))
    for p in parts[1:]:
        key = mixed(key + p.view(np.uint64))
    return key


class Filter:
    """Bits of the phrases of a table (``GRAM`` columns): ``holds`` is never false for one of them."""

    def __init__(self, phrases: DataFrame) -> None:
        bits, names = FILTER_BITS, phrases.columns

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = phrase_key([c.to_numpy() for c in b.columns]) % np.uint64(bits)
                columns = [(at >> np.uint64(5)).astype(np.int64), np.left_shift(1, (at & np.uint64(31)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["place", "bit"])

        rows = phrases.select(*[F.col(c) for c in names]).mapInArrow(place, "place long, bit long")
        rows = rows.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()  # FILTER_BITS / 32 rows at most
        self.words = np.zeros(-(-bits // 32), np.uint32)
        self.words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        self.bits = bits

    def holds(self, parts: list[np.ndarray]) -> np.ndarray:
        at = phrase_key(parts) % np.uint64(self.bits)
        return (self.words[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 == 1


def count_chunks(docs: DataFrame, size: int, parts: Filter, lang_col: str, text_col: str) -> DataFrame:
    """``h1, .., n``: the phrases of ``size`` words of each chunk of documents.

    ``parts`` holds the frequent phrases of one word less.
    """
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # of fixed size
    names = [*GRAM[:size], "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        number: dict[str, dict[bytes, int]] = {}
        following = count()
        sequences: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal following, held
            table = np.zeros(next(following), np.uint64)
            for lang, numbers in number.items():
                for w, i in numbers.items():
                    if i >= 0:
                        table[i] = word_hash(lang, w)
            words = np.concatenate([*sequences, np.array([-1])])
            number.clear(), sequences.clear()
            following, held = count(), 0
            last = len(words) - size + 1
            at = np.flatnonzero(np.logical_and.reduce([words[j : last + j] >= 0 for j in range(size)]))
            for j in range(2):  # both parts one word shorter
                at = at[frequent.holds([table[words[at + j + i]] for i in range(size - 1)])]
            if len(at):
                columns = [table[words[at + j]] for j in range(size)]
                key = phrase_key(columns)
                order = np.argsort(key, kind="stable")
                ordered = key[order]
                starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                first = order[starts]
                columns = [*(c[first].view(np.int64) for c in columns), np.diff(starts, append=len(order))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            release()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                if lang not in number:
                    number[lang] = defaultdict(lambda: next(following), {b"": -2, b"\n": -1})
                own = np.fromiter(map(number[lang].__getitem__, cut(text.as_py())), np.int64)
                own = own[own > -2]
                sequences += [own, np.array([-1])]
                held += len(own)
                if held >= CHUNK_WORDS:
                    yield from flush()
        yield from flush()

    return _texts(docs, lang_col, text_col).mapInArrow(run, ", ".join(f"{c} long not null" for c in names))


class Summary:
    """A Misra-Gries summary of weighted keys; ``taken`` is what every count may lack, always below ``least``."""

    def __init__(self, capacity: int, least: int, size: int) -> None:
        self.capacity, self.least, self.taken = capacity, least, 0
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, size), np.int64)
        self.counts = np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> None:
        keys, rows, counts = (np.concatenate(x) for x in ((self.keys, keys), (self.rows, rows), (self.counts, counts)))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.rows = keys[starts], rows[order[starts]]
        self.counts = np.add.reduceat(counts[order], starts) if len(keys) else counts
        while len(self.keys) > self.capacity:
            place = len(self.counts) - self.capacity - 1
            cut_off = int(np.partition(self.counts, place)[place])  # the largest count beyond the capacity
            if self.taken + cut_off >= self.least:
                self.capacity *= 2
                continue
            self.taken += cut_off
            stay = self.counts > cut_off
            self.keys, self.rows, self.counts = self.keys[stay], self.rows[stay], self.counts[stay] - cut_off

    def survivors(self) -> np.ndarray:
        return self.rows[self.counts + self.taken >= self.least]


def survivors(dealt: DataFrame, least: int) -> DataFrame:
    """The phrases that may have ``least`` occurrences, by one summary per partition."""
    capacity = PARTITION_MASS // least + 1
    names = dealt.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity, least, len(names))
        waiting: list[tuple] = []
        held = 0

        def merge() -> None:
            nonlocal held
            if waiting:
                summary.merge(*(np.concatenate(x) for x in zip(*waiting)))
            waiting.clear()
            held = 0

        for b in batches:
            *parts, n = (c.to_numpy() for c in b.columns)
            waiting.append((phrase_key(parts), np.stack(parts, axis=1), n))
            held += len(n)
            if held >= capacity:
                merge()
        merge()
        rows = summary.survivors()
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)
        release()

    return dealt.mapInArrow(run, ", ".join(f"{c} long not null" for c in names))


def frequent(docs: DataFrame, size: int, parts: Filter, least: int, lang_col: str, text_col: str) -> DataFrame:
    """``h1, .., a``: the exact counts of the phrases of ``size`` words with at least ``least`` occurrences."""
    total = docs.agg(F.sum(F.octet_length(col(text_col)))).first()[0] or 0
    # A word takes two bytes with what follows it, and opens at most one phrase.
    enough = -(-total // (2 * PARTITION_MASS))
    # With fewer partitions than the session's the join would deal the rows anew.
    partitions = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), enough)
    dealt = count_chunks(docs, size, parts, lang_col, text_col).repartition(partitions, *GRAM[:size])
    # An inner join (survivors are distinct): a semi join would move below the exchange, which then could not be reused.
    held = dealt.join(survivors(dealt, least).hint("shuffle_hash"), GRAM[:size])
    return held.groupBy(*GRAM[:size]).agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly; at most 1000000, as no part is rarer than the phrase."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def mine(
    docs: DataFrame,
    *,
    least: int = 10,
    cover_percent: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases.

    A phrase's cut into two parts with the lowest score counts, of equal ones
    the first.  Phrases inside a longer candidate that has at least
    ``cover_percent`` of their occurrences are left out.

    * NULL and empty texts have no words; a NULL language is ``und``.
    * Repeated rows are documents of their own; other columns are not read.
    * Ties are ranked by count, then by the phrase's bytes, so ranks are unique.
    * A table without candidates, an empty one too, gives no rows.
    """
    words = written(count_words(docs, lang_col, text_col), "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = words.where(F.col("n") >= least)  # every part of a candidate is as frequent
    pairs = written(frequent(docs, 2, Filter(known.select("h")), least, lang_col, text_col), "pairs")
    triples = written(frequent(docs, 3, Filter(pairs.select("h1", "h2")), least, lang_col, text_col), "triples")
    found = pairs.select("h1", "h2", F.lit(0).cast("long").alias("h3"), "a").union(triples)

    def word(i: int) -> DataFrame:
        more = [F.col("lang")] if i == 1 else []
        return known.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"n{i}"), *more)

    spelled = found.join(word(1), "h1").join(word(2), "h2").join(word(3), "h3", "left")
    named = lambda first, second, c: pairs.select(F.col("h1").alias(first), F.col("h2").alias(second), F.col("a").alias(c))
    inside = triples.select("h1", "h2", "a").union(triples.select("h2", "h3", "a"))
    inside = inside.groupBy("h1", "h2").agg(F.max("a").alias("around")).withColumn("h3", F.lit(0).cast("long"))
    rows = spelled.join(named("h1", "h2", "n12"), ["h1", "h2"], "left").join(named("h2", "h3", "n23"), ["h2", "h3"], "left")
    rows = rows.join(inside, GRAM, "left").where(
        F.col("around").isNull() | (F.lit(100).cast("long") * F.col("around") < F.lit(cover_percent).cast("long") * F.col("a"))
    )
    two = F.col("h3") == 0
    after_one = F.when(two, F.col("n2")).otherwise(F.col("n23"))
    first, second = _score(F.col("a"), F.col("n1"), after_one), F.when(~two, _score(F.col("a"), F.col("n12"), F.col("n3")))
    rows = rows.withColumns({"s1": first, "s2": second}).withColumn("later", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
    scored = rows.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(F.col("later"), F.col("n12")).otherwise(F.col("n1")).alias("l"),
        F.when(F.col("later"), F.col("n3")).otherwise(after_one).alias("r"),
        F.when(F.col("later"), F.col("s2")).otherwise(F.col("s1")).cast("long").alias("score"),
    )
    placed = global_rank(scored, [F.desc("score"), F.desc("a"), F.asc("phrase")], "rank", within=["lang"])
    return placed.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
