"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The library's result is that of one merge at a time: of all neighbouring
symbols whose join is a piece, the pair with the best score, of equal ones the
leftmost.  Here many words are merged at once:

1. A text is cut into words where no piece can reach across (before a blank
   that follows another character, checked against the vocabulary).  A task
   remembers the ids of a bounded number of words, so most are merged once.
2. The words' characters lie in one flat array, cut further wherever two
   neighbouring characters stand side by side in no piece.
3. A round finds the best rank of each segment (a segmented minimum), merges
   its occurrences from the left, every other one where they overlap, and
   compacts the array.  Segments without a pair leave it.  The rounds end when
   none is left.
4. Merging several occurrences at once is merging them one by one, unless a
   pair made on the way ranks no later than the merged one.  Such segments
   take their leftmost occurrence only.  Segments of more than ``LONG``
   symbols, which could need as many rounds, go through a heap.

Decoding gathers the bytes of the pieces.  Both are Arrow functions of a
column: no shuffle, and memory bounded by a batch of rows.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import col

BLANK = "▁"  # stands for a space
SHIFT = 21  # bits of a symbol in a pair
NONE = np.iinfo(np.int32).max  # the rank of a pair that is no piece
LONG = 1000  # symbols of a segment
CHUNK = 1_000_000  # characters, or ids, worked on at once
KNOWN_WORDS = 300_000  # whose ids a task remembers
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialised message: varints as integers, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 2: -1, 5: 4}[key & 7]
            size = varint() if size < 0 else size
            yield key >> 3, message[at : at + size]
            at += size


class Model:
    """The tables of a BPE model with byte fallback and identity normalisation (else ``ValueError``)."""

    def __init__(self, proto: bytes) -> None:
        self.pieces: list[str] = []
        scores, kinds = [], []
        trainer, rules = {}, {}
        for number, value in _fields(proto):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        fits = trainer.get(3) == 2 and trainer.get(35) and not trainer.get(24)
        if not fits or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback and identity normalisation")
        self.prefix = BLANK if rules.get(3, 1) else ""
        self.size = n = len(self.pieces)
        self.id_of = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        self.byte_id = np.zeros(256, np.int32)
        for i, p in enumerate(self.pieces):
            if kinds[i] == BYTE:
                self.byte_id[int(p[1:-1], 16)] = i

        # A character that is no piece is numbered behind the pieces.
        self.symbol = np.arange(n, n + 0x110000, dtype=np.int32)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        order = np.unique(-np.array(scores), return_inverse=True)[1]
        symbol = lambda s: int(self.symbol[ord(s)]) if len(s) == 1 else self.id_of.get(s)
        pairs, beside = {}, set()
        for p, i in self.id_of.items():
            beside.update((ord(a) << SHIFT) | ord(b) for a, b in zip(p, p[1:]))
            for cut in range(1, len(p)):
                a, b = symbol(p[:cut]), symbol(p[cut:])
                if a is not None and b is not None:
                    pairs[(a << SHIFT) | b] = (int(order[i]), i)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.joined = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.beside = np.array(sorted(beside), np.int64)
        # Words end before a blank, if no piece holds a blank behind another character.
        inside = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.id_of)
        self.words = re.compile("(?s).+") if inside else re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")

        surface = trainer.get(44, b" \xe2\x81\x87 ")
        said = {NORMAL: lambda p: p.replace(BLANK, " ").encode(), UNKNOWN: lambda p: surface, CONTROL: lambda p: b"",
                BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        said = [said[k](p) for k, p in zip(kinds, self.pieces)]
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_length = np.array([len(s) for s in said], np.int64)
        self.said_start = np.cumsum(self.said_length) - self.said_length
        self.is_byte, self.is_control = np.array(kinds) == BYTE, np.array(kinds) == CONTROL
        self.drops_blank = np.array([bool(self.prefix) and k == NORMAL and p.startswith(BLANK) for k, p in zip(kinds, self.pieces)])

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols; rank ``NONE`` where the join is no piece."""
        key = (left.astype(np.int64) << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NONE), self.joined[at]


@lru_cache(maxsize=4)
def load(proto: bytes) -> Model:
    """The model's tables, made once per worker."""
    return Model(proto)


def by_heap(model: Model, symbols: list[int]) -> list[int]:
    """The merges of one segment one at a time."""
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (found := model.pairs.get((symbols[i] << SHIFT) | symbols[j])):
            heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(len(symbols) - 1):
        offer(i)
    while heap:
        _, i, a, b, joined = heapq.heappop(heap)
        j = after[i]
        if j < 0 or symbols[i] != a or symbols[j] != b:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = joined, -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s in symbols if s >= 0]


def merge_rounds(model: Model, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sym`` after all merges inside the segments ``seg`` (ascending numbers), and where each symbol began."""
    pos = np.arange(len(sym))
    done_sym, done_pos = [np.zeros(0, sym.dtype)], [pos[:0]]

    def pairs(sym: np.ndarray, seg: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        follow = np.minimum(at + 1, len(sym) - 1)
        rank, into = model.find(sym[at], sym[follow])
        return np.where((follow > at) & (seg[at] == seg[follow]), rank, NONE), into

    rank, into = pairs(sym, seg, pos)
    while len(sym):
        starts = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        lengths = np.diff(starts, append=len(sym))
        least = np.minimum.reduceat(rank, starts)
        each = np.repeat(least, lengths)
        live = each != NONE
        if not live.all():  # finished segments leave
            done_sym.append(sym[~live]), done_pos.append(pos[~live])
            sym, seg, pos, rank, into, each = (x[live] for x in (sym, seg, pos, rank, into, each))
            if not len(sym):
                break
        at = np.flatnonzero(rank == each)
        # Of neighbouring candidates, which share a symbol, every other one from the left.
        opens = np.concatenate([[True], at[1:] != at[:-1] + 1])
        place = np.arange(len(at))
        take = at[(place - place[opens][np.cumsum(opens) - 1]) % 2 == 0]
        while True:
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            merged = sym.copy()
            merged[take] = into[take]
            new_sym, new_seg = merged[keep], seg[keep]
            here = take - np.arange(len(take))  # the merged symbols' new places
            near = np.zeros(len(new_sym), bool)
            near[here] = near[np.maximum(here - 1, 0)] = True
            around = np.flatnonzero(near)
            new_rank, new_into = pairs(new_sym, new_seg, around)
            # The pair that stands between two merges that touch.
            touch = np.flatnonzero((take[1:] == take[:-1] + 2) & (seg[take[1:]] == seg[take[:-1]]))
            between = model.find(into[take[touch]], sym[take[touch] + 2])[0]
            early = np.concatenate(
                [new_seg[around][new_rank <= each[keep][around]], seg[take[touch]][between <= each[take[touch]]]]
            )
            first = np.concatenate([[True], seg[take[1:]] != seg[take[:-1]]])
            again = ~first & np.isin(seg[take], early)
            if not again.any():
                break
            take = take[~again]
        sym, seg, pos = new_sym, new_seg, pos[keep]
        rank, into = rank[keep], into[keep]
        rank[around], into[around] = new_rank, new_into
    order = np.argsort(np.concatenate(done_pos), kind="stable")
    return np.concatenate(done_sym)[order], np.concatenate(done_pos)[order]


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of every stretch, one stretch behind the other."""
    total = np.cumsum(length)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - length), length)


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one behind the other, and each word's number of ids."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(w) for w in words])
    opens = np.zeros(len(text) + 1, bool)
    opens[np.cumsum(lengths) - lengths] = True
    side = (text[:-1] << SHIFT) | text[1:]
    at = np.minimum(np.searchsorted(model.beside, side), len(model.beside) - 1)
    cut = opens[:-1].copy()
    cut[1:] |= model.beside[at] != side
    sym, seg = model.symbol[text], np.cumsum(cut)
    starts = np.flatnonzero(cut)
    sizes = np.diff(starts, append=len(text))
    long = sizes > LONG
    short = ~np.repeat(long, sizes)
    got_sym, got_pos = merge_rounds(model, sym[short], seg[short])
    got_pos = np.flatnonzero(short)[got_pos]
    for s, n in zip(starts[long], sizes[long]):
        ids = by_heap(model, sym[s : s + n].tolist())
        got_sym = np.concatenate([got_sym, np.array(ids, np.int32)])
        got_pos = np.concatenate([got_pos, s + np.arange(len(ids))])  # only their order inside the word matters
    if long.any():
        order = np.argsort(got_pos, kind="stable")
        got_sym, got_pos = got_sym[order], got_pos[order]

    # A character that is no piece becomes its bytes.
    code = np.maximum(got_sym.astype(np.int64) - model.size, 0)
    spelled = got_sym >= model.size
    n_bytes = np.where(spelled, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
    out = np.repeat(got_sym, n_bytes)
    k = np.arange(len(out)) - np.repeat(np.cumsum(n_bytes) - n_bytes, n_bytes)
    is_code, c, n = np.repeat(spelled, n_bytes), np.repeat(code, n_bytes), np.repeat(n_bytes, n_bytes)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n] | (c >> (6 * (n - 1)))
    byte = np.where(k == 0, lead, 0x80 | ((c >> (6 * (n - 1 - k))) & 0x3F))
    out = np.where(is_code, model.byte_id[np.where(is_code, byte, 0)], out)
    word = np.cumsum(opens[:-1])[got_pos] - 1
    return out.astype(np.int32), np.bincount(word, n_bytes, minlength=len(words)).astype(np.int64)


class Encoder:
    """Encodes texts and remembers up to about ``KNOWN_WORDS`` distinct words of earlier ones."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and each text's number of ids."""
        model = self.model
        if len(self.number) > KNOWN_WORDS or len(self.flat) > 10 * KNOWN_WORDS:
            self._forget()
        before, number = len(self.number), self.number.__getitem__
        numbers: list[int] = []
        counts = []
        for t in texts:
            # An empty text gets no prefix either.
            words = model.words.findall(model.prefix + t.replace(" ", BLANK)) if t else ()
            numbers.extend(map(number, words))
            counts.append(len(words))
        flat, sizes = encode_words(model, list(islice(self.number, before, None)))
        self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        own_words, ends = np.array(numbers, np.int64), np.cumsum(np.array(counts, np.int64))
        own = self.sizes[own_words]
        total = np.concatenate([[0], np.cumsum(own)])
        starts = np.cumsum(self.sizes) - self.sizes
        return self.flat[_ragged(starts[own_words], own)], np.diff(total[np.concatenate([[0], ends])])


def encode_texts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one behind the other, and each text's number of ids."""
    return Encoder(model)(texts)


def _spelled(run: bytes) -> str:
    """A run of byte pieces; each byte that is part of no character becomes U+FFFD."""
    out, i = [], 0
    while i < len(run):
        for n in range(1, 5):
            try:
                out.append(run[i : i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _decode_one(model: Model, ids: np.ndarray) -> str:
    """One row whose byte pieces are not all whole characters."""
    out, run, begun = [], bytearray(), False
    for i in ids.tolist():
        lo = int(model.said_start[i])
        said = model.said[lo : lo + int(model.said_length[i])].tobytes()
        if model.is_byte[i]:
            run += said
            begun = True
            continue
        out.append(_spelled(bytes(run)))
        run.clear()
        out.append((said[1:] if model.drops_blank[i] and not begun else said).decode())
        begun |= not model.is_control[i]
    return "".join([*out, _spelled(bytes(run))])


def decode_ids(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The texts (UTF-8) of rows of ids, of which ``counts`` says how many belong to each row."""
    if len(ids) and (ids.min() < 0 or ids.max() >= model.size):
        raise ValueError("an id is not in the vocabulary")
    start, length = model.said_start[ids], model.said_length[ids]
    # The first piece that is no control piece loses the blank of the prefix.
    row = np.repeat(np.arange(len(counts)), counts)
    real = np.flatnonzero(~model.is_control[ids])
    heads = real[np.concatenate([[True], row[real][1:] != row[real][:-1]])] if len(real) else real
    heads = heads[model.drops_blank[ids[heads]]]
    start[heads] += 1
    length[heads] -= 1
    said = model.said[_ragged(start, length)]
    total = np.concatenate([[0], np.cumsum(length)])
    ends = np.cumsum(counts)
    lo, hi = total[ends - counts], total[ends]
    out = [said[a:b].tobytes() for a, b in zip(lo, hi)]
    if model.is_byte[ids].any():
        spelled, broken = np.unique(row[model.is_byte[ids]]), set(row[model.is_control[ids]].tolist())
        for r in spelled.tolist():
            try:
                out[r].decode()
                whole = r not in broken  # a control piece ends a run of bytes
            except UnicodeDecodeError:
                whole = False
            if not whole:
                out[r] = _decode_one(model, ids[ends[r] - counts[r] : ends[r]]).encode()
    return out


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK`` characters or ids in all."""
    total, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + CHUNK)))
        yield lo, hi
        lo = hi


def _shared(spark: SparkSession, path: str):
    """The model file, sent to each executor once; its size is that of a vocabulary, whatever the data."""
    with open(path, "rb") as f:
        proto = f.read()
    load(proto)  # an unsuitable model fails here
    return spark.sparkContext.broadcast(proto)


def encode(spark: SparkSession, text: Column, model_path: str) -> Column:
    """``array<int>``: the ids of ``text``, without begin or end ids.  A NULL text is an empty one."""
    shared = _shared(spark, model_path)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoded = Encoder(load(shared.value))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
            flat, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for lo, hi in _chunks(sizes):
                ids, n = encoded([t or "" for t in batch.slice(lo, hi - lo).to_pylist()])
                flat.append(ids), counts.append(n)
            ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat), pa.int32()))

    return run(text)


def decode(spark: SparkSession, ids: Column, model_path: str) -> Column:
    """The text of an array of ids.  NULL for NULL; NULL elements are left out; an unknown id fails."""
    shared = _shared(spark, model_path)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(shared.value)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            out: list[bytes | None] = []
            for lo, hi in _chunks(sizes):
                part = batch.slice(lo, hi - lo)
                flat, own = part.flatten(), pc.list_parent_indices(part)
                if flat.null_count:
                    flat, own = flat.filter(flat.is_valid()), own.filter(flat.is_valid())
                counts = np.bincount(own.to_numpy(), minlength=hi - lo)
                texts = decode_ids(model, flat.to_numpy(), counts)
                out += [t if ok else None for t, ok in zip(texts, part.is_valid().to_pylist())]
            yield pa.array(out, pa.binary()).cast(pa.string())

    return run(ids)


def round_trip(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids, decoded``, the ids of its text and the text of those ids.

    * NULL and empty texts have no ids and decode to the empty text.
    * Repeated rows are documents of their own; other columns are not read.
    * The decoded text differs from the text only where the text holds the
      sign that stands for a space, as with the library.
    * An empty table gives no rows.
    """
    spark = docs.sparkSession
    encoded = docs.select(col(id_col).alias("doc_id"), encode(spark, col(text_col), model_path).alias("ids"))
    return encoded.withColumn("decoded", decode(spark, F.col("ids"), model_path))
