"""Documents cut into words and packed into blocks, for array work inside tasks.

A block holds whole documents of one scan partition, about ``BLOCK_WORDS``
words in all (a longer document is a block of its own): the distinct words
once, and each document's words as numbers of that list.  Blocks are written
once to the shared folder; later steps read them instead of the texts.

``ask`` is the exchange the operators share: blocks ask about sorted 64-bit
keys, the keys are dealt out by range to bounded shards, a shard sees the
equal keys of all blocks and answers each block in the order it asked.  A
block asks once per distinct key, so a key that a third of all rows hold costs
one entry per block, not one per row.
"""

from __future__ import annotations

import ctypes
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import ascii_lower, col, written

BLOCK_WORDS = 1_000_000
SHARD_KEYS = 1_000_000
BLOCKS = (
    "block string, n_docs long, n_words long, ids binary, no_id binary, flags binary, lengths binary, "
    "vocabulary binary, words binary"
)


def release() -> None:
    """Hand freed memory back to the system.

    Python workers are used again by later tasks, and the allocators of Arrow
    and of the C library keep what a block has needed; without this a worker's
    size is its largest block ever, not its current one.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pack(a: np.ndarray) -> bytes:
    """An integer array, its bytes grouped by significance and deflated."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros((a.itemsize, 0), np.uint8)
    return zlib.compress(planes.tobytes(), 1)


def unpack(b: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def make_blocks(docs: DataFrame, *, flag: Column, lower: bool, id_col: str, text_col: str) -> DataFrame:
    """The written block table of all documents.  ``flag`` is a Boolean carried per document."""
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(
        col(id_col).cast("long").alias("doc_id"), flag.alias("flag"), (ascii_lower(text) if lower else text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        ids: list = []
        flags: list = []
        lengths: list = []
        numbers: list = []
        known: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            columns = [
                [uuid.uuid4().hex], [len(ids)], [len(numbers)],
                [pack(np.array([i or 0 for i in ids], np.int64))], [pack(np.array([i is None for i in ids], np.int8))],
                [pack(np.array(flags, np.int8))], [pack(np.array(lengths, np.int32))],
                [zlib.compress(b" ".join(known), 1)], [pack(np.array(numbers, np.int32))],
            ]
            for x in (ids, flags, lengths, numbers, known):
                x.clear()
            types = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
            names = ["block", "n_docs", "n_words", "ids", "no_id", "flags", "lengths", "vocabulary", "words"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for b in batches:
            for doc_id, mark, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = body.as_py().encode().split()
                number = known.setdefault
                numbers.extend([number(w, len(known)) for w in words])
                ids.append(doc_id), flags.append(mark), lengths.append(len(words))
                if len(numbers) >= BLOCK_WORDS:
                    yield flush()
                    release()
        if ids:
            yield flush()
        release()

    return written(rows.mapInArrow(run, BLOCKS), "blocks")


class Block:
    """One row of the block table, unpacked."""

    def __init__(self, row) -> None:
        self.name = row["block"]
        self.flags = unpack(row["flags"], np.int8).astype(bool)
        self.lengths = unpack(row["lengths"], np.int32).astype(np.int64)
        self.vocabulary = zlib.decompress(row["vocabulary"]).split()
        self.words = unpack(row["words"], np.int32)

    def word_hashes(self) -> np.ndarray:
        """64-bit hash of each distinct word."""
        h = xxhash.xxh64_intdigest
        return np.array([h(w) for w in self.vocabulary], dtype=np.uint64)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; the memory of each goes back before the next."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]
            release()


def doc_ids(ids: bytes, no_id: bytes) -> pa.Array:
    return pa.array(unpack(ids, np.int64), pa.int64(), mask=unpack(no_id, np.int8).astype(bool))


def mixed(a: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    a = a ^ (a >> np.uint64(33))
    a = a * np.uint64(0xFF51AFD7ED558CCD)
    a = a ^ (a >> np.uint64(33))
    a = a * np.uint64(0xC4CEB9FE1A85EC53)
    return a ^ (a >> np.uint64(33))


def shard_count(blocks: DataFrame, keys_per_word: float) -> int:
    words = blocks.agg(F.sum("n_words") + F.sum("n_docs")).first()[0] or 0
    return max(1, math.ceil(words * keys_per_word / SHARD_KEYS))


def ask(
    blocks: DataFrame,
    shards: int,
    question: Callable[[Block], list[tuple[int, np.ndarray, list[np.ndarray]]]],
    answer: Callable[[int, list[np.ndarray], list[list[np.ndarray]]], tuple[list[np.ndarray], int]],
    value_types: list[str],
    answer_type: str,
) -> DataFrame:
    """Written table of answers: ``block, kind, shard, answer, total``.

    ``question(block)`` gives, per kind, sorted distinct keys with arrays of
    values; ``answer(kind, keys, values)`` sees a shard's lists of all blocks
    and gives an array per block, and one number for the shard (``total``, in
    the first row of the shard).
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("block", pa.string()), ("keys", pa.binary()),
                            ("values", pa.list_(pa.binary()))])
        for row in block_rows(batches):
            block = Block(row)
            for kind, keys, values in question(block):
                place = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                cuts = np.searchsorted(place, np.arange(shards + 1).astype(np.uint64))
                out = []
                for s in range(shards):
                    lo, hi = cuts[s], cuts[s + 1]
                    if hi > lo:
                        cells = [pack(v[lo:hi].astype(t)) for v, t in zip(values, value_types)]
                        out.append((s, kind, block.name, pack_keys(keys[lo:hi]), cells))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def answered(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = int(pdf["kind"].iloc[0])
        keys = [unpack_keys(k) for k in pdf["keys"]]
        values = [[unpack(c, t) for c, t in zip(cells, value_types)] for cells in pdf["values"]]
        answers, total = answer(kind, keys, values)
        release()
        return pd.DataFrame(
            {"block": pdf["block"], "kind": kind, "shard": pdf["shard"], "answer": [pack(a.astype(answer_type)) for a in answers],
             "total": [total] + [0] * (len(pdf) - 1)}
        )

    requests = blocks.mapInArrow(asked, "shard int, kind int, block string, keys binary, values array<binary>")
    replies = requests.groupBy("shard", "kind").applyInPandas(
        answered, "block string, kind int, shard int, answer binary, total long"
    )
    return written(replies, "answers")


def no_rows(*names: str) -> pd.DataFrame:
    """An empty frame that Arrow takes for columns of any type."""
    return pd.DataFrame(columns=list(names), dtype=object)


def gathered(pdf: pd.DataFrame, kind: int, dtype) -> np.ndarray:
    """A block's answers of one kind, in the order of its question."""
    rows = pdf[pdf["kind"] == kind].sort_values("shard")
    return np.concatenate([unpack(a, dtype) for a in rows["answer"]]) if len(rows) else np.zeros(0, dtype)
