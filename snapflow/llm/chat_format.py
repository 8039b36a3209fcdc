"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all preceding turns of its
conversation as context, and only that reply under the loss mask.  Turns that
follow the last assistant turn have no example to stand in, so they come in
one more record with an empty mask (``trainable`` false).

Template of a turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  A text can hold
the control strings itself.  Escaping puts one more backslash into every
``<``, backslashes, ``|`` run, so no ``<|`` is left inside a text and the
change can be undone exactly (``unescape``).

A conversation is one ordered text.  Its rows are brought to one task, sorted
there by Spark's spilling sort and read as a stream: only the formatted prefix
of the current conversation is held.  The output grows with the square of a
conversation's length; that is what the expansion asks for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import col

START, END = "<|im_start|>", "<|im_end|>"
BATCH_CHARS = 4_000_000
EXAMPLES = (
    "conv_id long, example long, text string, loss_start long, loss_end long, trainable boolean, last boolean"
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"

_RAW = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The formatted turn and where its text begins in it."""
    head = f"{START}{escape_role(role)}\n"
    return f"{head}{escape(text)}{END}\n", len(head)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; fails on anything outside the template."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn mark at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END + "\n", line)
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def _expand(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Examples of rows ordered by conversation and turn."""
    parts: list[str] = []
    length = example = pending = 0
    current: object = _expand  # no conversation yet

    held = None  # the last example of the conversation, until it is known to be the last

    def close() -> Iterator[tuple]:
        if held and not pending:
            yield (*held, True)
        elif held:
            yield (*held, False)
        if pending:
            yield (current, example, "".join(parts), length, length, False, True)

    for conv, role, text in rows:
        if conv != current:
            yield from close()
            current, parts, length, example, pending, held = conv, [], 0, 0, 0, None
        role, text = role or "", text or ""
        turn, offset = format_turn(role, text)
        parts.append(turn)
        if role == "assistant":
            if held:
                yield (*held, False)
            parts = ["".join(parts)]
            start = length + offset
            held = (conv, example, parts[0], start, length + len(turn) - len(END) - 1, True)
            example, pending = example + 1, 0
        else:
            pending += 1
        length += len(turn)
    yield from close()


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], chars) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(list(zip(names, types)))
    buffer, size = [], 0
    for row in rows:
        buffer.append(row)
        size += chars(row)
        if size >= BATCH_CHARS or len(buffer) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), types)], schema=schema)
            buffer, size = [], 0
    if buffer:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), types)], schema=schema)


def expand(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Examples: ``conv_id, example, text, loss_start, loss_end, trainable, last``.

    ``loss_start`` / ``loss_end`` are code-point offsets of the reply in the
    formatted text.  A conversation's examples stand next to each other, in
    order, in one partition; ``last`` marks the one that holds every turn.

    * NULL role or text counts as empty; an empty reply has an empty mask.
    * NULL conv_id is one conversation of its own; NULL turn sorts first.
    * Rows equal in conv_id and turn are all kept, ordered by role and text.
    * Other columns are not read.  An empty table gives no rows.
    """
    ordered = (
        turns.select(
            col(conv_col).cast("long").alias("conv_id"),
            col(turn_col).alias("turn"),
            col(role_col).alias("role"),
            col(text_col).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        names = ["conv_id", "example", "text", "loss_start", "loss_end", "trainable", "last"]
        yield from _batches(_expand(rows), names, types, lambda r: len(r[2]))

    return ordered.mapInArrow(run, EXAMPLES)


def digests(examples: DataFrame) -> DataFrame:
    """Read ``expand``'s output back: one row of digests per conversation."""

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        loss, loss_chars, chars, n = hashlib.sha256(), 0, 0, 0
        for conv, _, text, start, end, trainable, last in rows:
            n += 1
            chars += len(text)
            if trainable:
                reply = unescape(text[start:end])
                loss_chars += len(reply)
                loss.update(reply.encode())
            if last:
                turns, said = parse_turns(text), hashlib.sha256()
                for role, said_text in turns:
                    said.update(f"{role}\n{said_text}\n".encode())
                yield conv, len(turns), said.hexdigest(), loss_chars, loss.hexdigest(), chars, n
                loss, loss_chars, chars, n = hashlib.sha256(), 0, 0, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]
        yield from _batches(read(rows), names, types, lambda r: 0)

    return examples.mapInArrow(run, DIGESTS)
