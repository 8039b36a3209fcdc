"""Substring dedup by suffix automata over reference shards.

A window is ``window`` consecutive words of one document; every word covered
by a window whose words also start anywhere else in the corpus is removed.

The reference is the corpus itself and has no size bound, so its automata
cannot be broadcast.  They are built where their shard lands instead, and the
passages to match are brought there:

1. Winnowing: of the seeds (hashed runs of ``seed`` words) inside a window the
   one with the smallest hash, of equal ones the last, is the window's anchor.
   It depends on the window's words alone, so equal windows have equal anchors.
   Consecutive windows with the same anchor occurrence form a run.
2. Blocks ask (``blocks.ask``) about their distinct runs: a run whose whole
   content occurs again is repeated; an anchor with several contents is
   contested; any other run is alone, and none of its windows is repeated.
3. Each content of a contested anchor is sent once as a passage to the anchor's
   shard.  The shard builds a suffix automaton over its passages, streams them
   through it for matching statistics and reports the maximal spans of at
   least ``window`` words that occur more than once.  A crowded anchor (more
   than ``crowd`` contents) is cut into single windows, dealt out by their own
   hash, so no shard has to hold it.
4. Each block removes the words of its repeated runs and reported spans.

All steps are exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.blocks import Block, ask, doc_ids, gathered, make_blocks, mixed, no_rows, pack, release, shard_count, unpack
from snapflow.llm.common import written

ALONE, REPEATED, CONTESTED, CROWDED = 0, 1, 2, 4  # flags of a run
RUNS = 1
PASSAGE_WORDS = 500_000  # of one shard's automaton, about
BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2^64


class SuffixAutomaton:
    """Of several sequences of integers, with the number of places where each state's strings end."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [0]

    def _state(self, length: int, ends: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.ends.append(ends)
        self.link.append(link)
        return len(self.next) - 1

    def add(self, sequence: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            p, known = last, nxt[last].get(c)
            if known is not None:  # the extended string is in the automaton already
                if length[known] == length[last] + 1:
                    last = known
                else:
                    last = self._split(p, c, known)
                self.ends[last] += 1
                continue
            new = self._state(length[last] + 1, 1, {}, 0)
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, 0, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def close(self) -> None:
        """Sum the end places along the suffix links."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.ends[self.link[s]] += self.ends[s]

    def matches(self, sequence: list[int], least: int = 2) -> Iterator[int]:
        """Matching statistics: at each place, the longest suffix that ends at ``least`` places of the shard."""
        nxt, link, length, ends = self.next, self.link, self.length, self.ends
        state = n = 0
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            if c in nxt[state]:
                state, n = nxt[state][c], n + 1
            while state and ends[state] < least:
                state = link[state]
                n = length[state]
            yield n


def maximal_spans(stats: Iterator[int], window: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the maximal stretches covered by matches of at least ``window`` words."""
    start = end = None
    for i, n in enumerate(stats, 1):
        if n >= window:
            if end is not None and i - n <= end:
                start, end = min(start, i - n), i
            else:
                if end is not None:
                    yield start, end
                start, end = i - n, i
    if end is not None:
        yield start, end


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have, out = 1, a
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Runs:
    """The runs of a block: windows with the same anchor occurrence, in order."""

    def __init__(self, block: Block, window: int, seed: int) -> None:
        hashes = block.word_hashes()
        self.h = hashes[block.words] if len(hashes) else np.zeros(0, np.uint64)
        n = len(self.h)
        self.first = np.cumsum(block.lengths) - block.lengths
        self.lengths = block.lengths
        self.start = self.count = self.doc = np.zeros(0, np.int64)
        self.anchor = self.content = np.zeros(0, np.uint64)
        if n < window:
            return
        up = np.cumprod(np.full(n + 1, BASE, np.uint64))
        down = np.cumprod(np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.h * up[:n], dtype=np.uint64)])
        self.down = down
        seeds = self.hash_of(np.arange(n - seed + 1), np.full(n - seed + 1, seed))
        # The place, reversed, breaks ties towards the last; it fills the low bits.
        low = np.uint64((1 << 28) - 1)
        place = low - np.arange(len(seeds), dtype=np.uint64)
        if len(seeds) > int(low):
            raise ValueError("block too long")
        least = _sliding_min((seeds & ~low) | place, window - seed + 1)
        at = (low - (least & low)).astype(np.int64)  # anchor place of the window that starts here
        doc = np.repeat(np.arange(len(block.lengths)), block.lengths)[: len(at)]
        inside = np.arange(len(at)) + window <= (self.first + self.lengths)[doc]
        begins = inside.copy()
        begins[1:] &= ~(inside[:-1] & (at[1:] == at[:-1]))
        self.start = np.nonzero(begins)[0]
        if not len(self.start):
            return
        run = np.cumsum(begins) - 1
        self.count = np.bincount(run[inside], minlength=len(self.start))
        self.doc = doc[self.start]
        # Least hashes are small numbers: mixed again they spread evenly over the shards.
        self.anchor = mixed(seeds[at[self.start]])
        self.content = mixed(self.hash_of(self.start, self.count + window - 1) ^ mixed(self.anchor))
        # Where the anchor stands in the run tells runs of equal words and different extent apart.

    def hash_of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` on; depends on the words alone."""
        raw = (self.sums[start + length] - self.sums[start]) * self.down[start]
        return mixed(raw + length.astype(np.uint64))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted (anchor, content) pairs, their occurrences here, the first of them, and the pair of each run."""
        order = np.lexsort((self.content, self.anchor))
        a, c = self.anchor[order], self.content[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        firsts = order[np.nonzero(new)[0]]
        return firsts, np.bincount(pair, minlength=len(firsts)), pair, a[new]


def _question(window: int, seed: int):
    def question(block: Block) -> list[tuple[int, np.ndarray, list[np.ndarray]]]:
        runs = Runs(block, window, seed)
        firsts, times, _, anchors = runs.distinct()
        # Keys may repeat (an anchor's contents): they are sorted, which is all the exchange needs.
        return [(RUNS, anchors, [runs.content[firsts], np.minimum(times, 2)])] if len(firsts) else []

    return question


def _answer(crowd: int):
    def answer(kind: int, keys: list[np.ndarray], values: list[list[np.ndarray]]) -> tuple[list[np.ndarray], int]:
        """Flags per run; the first block that holds a content of a contested anchor sends it."""
        a, c = np.concatenate(keys), np.concatenate([v[0] for v in values])
        n = np.concatenate([v[1] for v in values]).astype(np.int64)
        order = np.lexsort((c, a))  # stable: the first asker leads
        sa, sc = a[order], c[order]
        new_a = np.ones(len(a), dtype=bool)
        new_a[1:] = sa[1:] != sa[:-1]
        new_c = new_a.copy()
        new_c[1:] |= sc[1:] != sc[:-1]
        group, anchor = np.cumsum(new_c) - 1, np.cumsum(new_a) - 1
        times = np.bincount(group, n[order])
        contents = np.bincount(anchor, new_c.astype(np.int64))
        flags = np.where(times[group] >= 2, REPEATED, ALONE)
        several = contents[anchor]
        flags = flags | np.where(new_c & (several > 1), CONTESTED, 0) | np.where(new_c & (several > crowd), CROWDED, 0)
        out = np.empty(len(a), np.int64)
        out[order] = flags
        return np.split(out, np.cumsum([len(k) for k in keys])[:-1]), int((flags & CONTESTED > 0).sum())

    return answer


def _cells(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def remove_repeats(
    docs: DataFrame, *, window: int = 35, seed: int = 12, crowd: int = 1000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256, kept``.

    ``kept`` is the text without the removed words, joined by single spaces.

    * NULL and empty texts have no words and keep the empty text.
    * Documents shorter than ``window`` words lose nothing.
    * Repeated rows are documents of their own, so their windows repeat.
    * Windows are judged on the input; both (all) occurrences are removed.
    * A text is one cell of a table and so below 2 GB; a block takes up to 2^28
      words, more than fit in one.
    * Other columns are not read.  An empty table gives no rows.
    """
    blocks = make_blocks(docs, flag=F.lit(False), lower=False, id_col=id_col, text_col=text_col)
    shards = shard_count(blocks, 2.0 / (window - seed + 2))
    answers = ask(blocks, shards, _question(window, seed), _answer(crowd), ["<u8", "<u1"], "<u1")
    contested = answers.agg(F.sum("total")).first()[0] or 0
    groups = max(1, int(contested * 2 * window / PASSAGE_WORDS))

    def passages(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Contents to compare: where they stand and their words."""
        names = ["shard", "block", "start", "least", "words"]
        if not len(left) or not len(right):
            return no_rows(*names)
        block = Block(left.iloc[0])
        runs = Runs(block, window, seed)
        flags = gathered(right, RUNS, "<u1")
        firsts = runs.distinct()[0]
        out = []
        for f, r in zip(flags[flags & CONTESTED > 0], firsts[flags & CONTESTED > 0]):
            start, n = int(runs.start[r]), int(runs.count[r])
            if f & CROWDED:
                for i in range(start, start + n):
                    key = int(runs.hash_of(np.array([i]), np.array([window]))[0])
                    out.append((key % groups, block.name, i, f & REPEATED, runs.h[i : i + window].tobytes()))
            else:
                out.append((int(runs.anchor[r]) % groups, block.name, start, f & REPEATED, runs.h[start : start + n + window - 1].tobytes()))
        release()
        return pd.DataFrame(out, columns=names) if out else no_rows(*names)

    sent = written(
        blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
            passages, "shard long, block string, start long, least int, words binary"
        ),
        "passages",
    )

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        """Spans of a shard's passages that occur more than once in it."""
        found = SuffixAutomaton()
        sequences = [np.frombuffer(w, np.uint64).tolist() for w in pdf["words"]]
        for s in sequences:
            found.add(s)
        found.close()
        out = []
        for block, start, done, s in zip(pdf["block"], pdf["start"], pdf["least"], sequences):
            if not done:  # a repeated content is removed whole by its own flag
                out += [(block, start + lo, start + hi) for lo, hi in maximal_spans(found.matches(s), window)]
        release()
        return pd.DataFrame(out, columns=["block", "lo", "hi"]) if out else no_rows("block", "lo", "hi")

    spans = written(sent.groupBy("shard").applyInPandas(shared, "block string, lo long, hi long"), "spans")
    notes = answers.select("block", "kind", "shard", "answer", F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"))
    notes = notes.union(spans.select("block", F.lit(0), F.lit(0), F.lit(None).cast("binary"), "lo", "hi"))

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return no_rows("ids", "no_id", "lengths", "removed", "digest", "kept")
        row = left.iloc[0]
        block = Block(row)
        runs = Runs(block, window, seed)
        gone = np.zeros(len(block.words) + 1, np.int64)
        if len(runs.start):
            flags = gathered(right, RUNS, "<u1")
            hit = (flags & REPEATED > 0)[runs.distinct()[2]]
            np.add.at(gone, runs.start[hit], 1)
            np.add.at(gone, runs.start[hit] + runs.count[hit] + window - 1, -1)
        extra = right[right["kind"] == 0]
        np.add.at(gone, extra["lo"].to_numpy(np.int64), 1)
        np.add.at(gone, extra["hi"].to_numpy(np.int64), -1)
        stays = np.cumsum(gone[:-1]) == 0
        digests, texts, removed = [], [], []
        for lo, n in zip(runs.first, block.lengths):
            own = block.words[lo : lo + n][stays[lo : lo + n]]
            text = b" ".join([block.vocabulary[w] for w in own])
            digests.append(hashlib.sha256(text).hexdigest())
            texts.append(text.decode())
            removed.append(int(n) - len(own))
        release()
        return pd.DataFrame(
            {"ids": [row["ids"]], "no_id": [row["no_id"]], "lengths": [row["lengths"]],
             "removed": [pack(np.array(removed, np.int32))], "digest": ["".join(digests)], "kept": [texts]}
        )

    done = blocks.groupBy("block").cogroup(notes.groupBy("block")).applyInPandas(
        finish, "ids binary, no_id binary, lengths binary, removed binary, digest string, kept array<string>"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                            ("kept", pa.string())])
        for b in batches:
            for i in range(b.num_rows):
                ids, no_id, lengths, removed, digest = (b.column(c)[i].as_py() for c in range(5))
                yield _cells(
                    [doc_ids(ids, no_id), unpack(lengths, np.int32), unpack(removed, np.int32),
                     [digest[j : j + 64] for j in range(0, len(digest), 64)], b.column(5)[i].values],
                    schema,
                )

    return done.mapInArrow(rows, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
