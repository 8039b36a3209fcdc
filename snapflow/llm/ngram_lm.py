"""Bigram language model with deleted interpolation.

``P(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1)``, where b
is the bucket of the context's frequency (powers of two).  The weights of each
bucket are learned by expectation-maximisation on held-out counts: every
training token is predicted from the counts with its own document deleted.
What EM needs of a token is its bucket and two likelihood ratios; these are
counted over all training tokens in bins of 1/16 of a natural logarithm, so EM
runs on one bounded table.

Counts travel as in ``blocks.ask``: a block asks about each of its distinct
words and bigrams once and brings its training counts, the shards add up and
answer.  The model is never in one place; each block scores its documents with
the counts it asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.blocks import Block, ask, block_rows, doc_ids, gathered, make_blocks, mixed, no_rows, pack, release, shard_count, unpack
from snapflow.llm.common import col, written

END, START = 1, 2  # stand-ins for word hashes
BUCKETS = 40
BIN = 16  # bins per natural logarithm
NONE = -32768  # bin of an estimate of zero
WORD, PAIR = 1, 2
SLICE = 1 << 17  # tokens of a block that are worked on at once, about


class Grams:
    """Words and bigrams of a block: one token per word and an end per document."""

    def __init__(self, block: Block) -> None:
        self.lengths = block.lengths + 1
        n_docs, n = len(self.lengths), int(self.lengths.sum())
        self.doc = np.repeat(np.arange(n_docs), self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths
        ends = self.first + self.lengths - 1
        is_end = np.zeros(n, dtype=bool)
        is_end[ends] = True
        hashes = np.append(block.word_hashes(), np.uint64(END))
        token = np.full(n, len(hashes) - 1, dtype=np.int64)
        token[~is_end] = block.words
        h = hashes[token]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.first] = START
        self.train = ~block.flags[self.doc]
        self.word_keys, self.word = np.unique(h, return_inverse=True)
        self.pair_keys, self.pair = np.unique(mixed(before * np.uint64(0x9E3779B97F4A7C15) + h), return_inverse=True)

    def counts(self, which: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(which[self.train], minlength=size)

    def own(self, which: np.ndarray, size: int) -> np.ndarray:
        """How often each token's word (or bigram) occurs in the token's document."""
        _, at, n = np.unique(self.doc * size + which, return_inverse=True, return_counts=True)
        return n[at]


def _question(block: Block) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
    g = Grams(block)
    return [
        (WORD, g.word_keys, [g.counts(g.word, len(g.word_keys))]),
        (PAIR, g.pair_keys, [g.counts(g.pair, len(g.pair_keys))]),
    ]


def _answer(kind: int, keys: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[list[np.ndarray], int]:
    """Total training count of each key; the shard's number of distinct training words."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, np.concatenate([v[0] for v in values]).astype(np.float64), len(distinct)).astype(np.int64)
    parts = np.split(totals[at], np.cumsum([len(k) for k in keys])[:-1])
    return parts, int((totals > 0).sum()) if kind == WORD else 0


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).astype(np.int64).clip(0, BUCKETS - 1)


def _bins(p: np.ndarray, floor: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.round(BIN * np.log(np.maximum(p, 1e-300) / floor)), NONE).astype(np.int64)


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = 60) -> np.ndarray:
    """EM over (bucket, bigram bin, word bin, tokens): weights of bigram, word and uniform per bucket.

    Buckets without held-out tokens take the weights of the nearest smaller one that has some.
    """
    weights = np.full((BUCKETS, 3), np.nan)
    if cells:
        b, r2, r1, n = (np.array(x) for x in zip(*cells))
        p = np.ones((len(n), 3))
        p[:, 0] = np.where(r2 == NONE, 0.0, np.exp(r2 / BIN))
        p[:, 1] = np.where(r1 == NONE, 0.0, np.exp(r1 / BIN))
        for k in np.unique(b):
            own = b == k
            w = np.array([0.0, 0.5, 0.5]) if k == 0 else np.full(3, 1 / 3)
            for _ in range(rounds):
                share = p[own] * w
                share /= share.sum(axis=1, keepdims=True)
                w = (share * n[own][:, None]).sum(axis=0) / n[own].sum()
            # Never rule out an unseen word.
            w[2] = max(w[2], 1e-6)
            weights[k] = w / w.sum()
    for k in range(BUCKETS):
        if np.isnan(weights[k]).any():
            weights[k] = weights[k - 1] if k > 1 else [0.0, 0.5, 0.5] if k == 0 else [0.1, 0.5, 0.4]
    return weights


def held_out(id_column: Column) -> Column:
    """Rows kept out of learning: crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the whole text with its end; ``base_score``
    is the add-one unigram estimate.

    * NULL and empty texts are one token, the end.
    * A NULL id is not held out.  Repeated rows are documents of their own.
    * Without training tokens every estimate is uniform over one unknown word:
      both scores are 0.  An empty table gives no rows.  Other columns are not read.
    """
    blocks = make_blocks(docs, flag=held_out(col(id_col)), lower=True, id_col=id_col, text_col=text_col)
    shards = shard_count(blocks, 0.8)
    answers = ask(blocks, shards, _question, _answer, ["<u4"], "<u4")
    v = answers.agg(F.sum("total")).first()[0] or 0

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Per token: counts of the word, the bigram and the context; for training tokens also without their document."""
        if not len(left):
            return no_rows("ids", "no_id", "flags", "lengths", "c1", "c2", "own1", "own2")
        row = left.iloc[0]
        block = Block(row)
        g = Grams(block)
        c1 = gathered(right, WORD, "<u4")[g.word]
        c2 = gathered(right, PAIR, "<u4")[g.pair]
        own1, own2 = g.own(g.word, len(g.word_keys)), g.own(g.pair, len(g.pair_keys))
        release()
        return pd.DataFrame(
            {"ids": [row["ids"]], "no_id": [row["no_id"]], "flags": [row["flags"]],
             "lengths": [pack(g.lengths.astype(np.int32))], "c1": [pack(c1.astype(np.uint32))], "c2": [pack(c2.astype(np.uint32))],
             "own1": [pack(own1.astype(np.uint32))], "own2": [pack(own2.astype(np.uint32))]}
        )

    counted = written(
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
            join, "ids binary, no_id binary, flags binary, lengths binary, c1 binary, c2 binary, own1 binary, own2 binary"
        ),
        "counted",
    )

    def training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_in = tokens_in = 0
            for flags, lengths in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = unpack(lengths, np.int32)[~unpack(flags, np.int8).astype(bool)]
                docs_in, tokens_in = docs_in + len(own), tokens_in + int(own.sum())
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (docs_in, tokens_in)], names=["docs", "tokens"])

    figures = counted.select("flags", "lengths").mapInArrow(training, "docs long, tokens long")
    train_docs, n_train = (x or 0 for x in figures.agg(F.sum("docs"), F.sum("tokens")).first())
    uniform = 1.0 / (v + 1)

    def slices(row: dict, *more: str) -> Iterator[tuple]:
        """Of consecutive documents: where they stand, their lengths and first tokens, the tokens' counts, contexts and ``more``."""
        lengths = unpack(row["lengths"], np.int32).astype(np.int64)
        counts = [unpack(row[c], np.uint32) for c in ("c1", "c2", *more)]
        ends = np.cumsum(lengths)
        starts = np.flatnonzero(np.diff((ends - 1) // SLICE, prepend=-1))
        for lo, hi in zip(starts, [*starts[1:], len(lengths)]):
            own = lengths[lo:hi]
            first = np.cumsum(own) - own
            c1, *rest = (c[ends[lo] - lengths[lo] : ends[hi - 1]].astype(np.int64) for c in counts)
            context = np.empty_like(c1)
            context[1:] = c1[:-1]
            context[first] = train_docs  # every training document starts once
            yield slice(lo, hi), own, first, context, c1, *rest

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("r2", pa.int32()), ("r1", pa.int32()), ("n", pa.int64())])
        for row in block_rows(batches):
            flags = unpack(row["flags"], np.int8).astype(bool)
            found = []
            for place, lengths, first, context, c1, c2, own1, own2 in slices(row, "own1", "own2"):
                before = np.empty_like(own1)
                before[1:] = own1[:-1]
                before[first] = 1
                doc = np.repeat(np.arange(len(lengths)), lengths)
                train = ~flags[place][doc]
                c, n_left = (context - before)[train], (n_train - lengths[doc])[train]
                p2 = np.where(c > 0, (c2 - own2)[train] / np.maximum(c, 1), 0.0)
                p1 = np.where(n_left > 0, (c1 - own1)[train] / np.maximum(n_left, 1), 0.0)
                k = (bucket(c) << 40) + ((_bins(p2, uniform) + 32768) << 20) + (_bins(p1, uniform) + 32768)
                found.append(np.unique(k, return_counts=True))
            k, at = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            n = np.zeros(len(k), np.int64)
            np.add.at(n, at, np.concatenate([x for _, x in found]))
            columns = [k >> 40, ((k >> 20) & 0xFFFFF) - 32768, (k & 0xFFFFF) - 32768, n]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    cells = counted.mapInArrow(ratios, "bucket int, r2 int, r1 int, n long").groupBy("bucket", "r2", "r1").agg(F.sum("n").alias("n"))
    # Bounded by buckets x bins, whatever the corpus.
    weights = learn_weights([tuple(r) for r in cells.collect()])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for row in block_rows(batches):
            ids, flags = doc_ids(row["ids"], row["no_id"]), unpack(row["flags"], np.int8).astype(bool)
            for place, lengths, first, context, c1, c2 in slices(row):
                base = np.log10((c1 + 1) / (n_train + v + 1))
                w = weights[bucket(context)]
                p = w[:, 0] * (c2 / np.maximum(context, 1)) + w[:, 1] * (c1 / max(n_train, 1)) + w[:, 2] * uniform
                p = np.log10(p) if n_train else np.zeros(len(c1))
                per = lambda x: np.add.reduceat(x, first)
                columns = [
                    ids[place.start : place.stop], flags[place], lengths, per((c1 > 0).astype(np.int64)), np.full(len(lengths), n_train),
                    per(base), per(p),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    return counted.mapInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
