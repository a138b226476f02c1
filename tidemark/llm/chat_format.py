r"""Chat formatting by prefix-target expansion.

Every assistant turn of a conversation becomes an example of its own: all
preceding turns are its context, and only that reply is trainable.  Turns after
the last reply make one more example without a trainable span, so a
conversation's last example always holds all of its turns.

Template: a turn is ``<|im_start|>role\ntext<|im_end|>\n``.  Control strings
inside roles and texts are escaped reversibly: between ``<`` and ``|`` that
have only backslashes between them, one backslash is added.  A role's own
backslashes and line ends are written ``\\`` and ``\n``.  The trainable span is
the escaped text of the reply, in code points of the example.

A conversation's turns are brought together by one shuffle and stream by in
turn order.  A task holds one example at a time.  The examples of a
conversation share their prefix: ``shared=True`` gives each example without the
text that the one before it already has (``prefix_chars`` says how much that
is), which is linear in the conversation; whole examples are its running
concatenation, and their total length grows with the square of the
conversation's, as the method has it.

Defined cases: null text or role is empty; the rows with a null conv_id are one
conversation; turns are in order of turn (null first), role, text; equal rows
are turns of their own; only the role ``assistant`` (exactly) is a reply; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import default_partitions

START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"
#: Characters of text in one Arrow batch of examples (a longer example is a batch of its own).
BATCH_CHARS = 4_000_000

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def head(role: str) -> str:
    return f"{START}{escape_role(role)}\n"


def parse(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted example."""
    at = 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.index("\n", at)
        end = text.index(END, line + 1)
        yield unescape_role(text[at + len(START):line]), unescape(text[line + 1:end])
        at = end + len(END) + 1


EXAMPLE = ("conv_id {conv}, example int, n_turns long, prefix_chars long, text string, loss_start long, loss_end long, "
           "last boolean")


class _Builder:
    """Examples of conversations whose turns arrive in order."""

    def __init__(self, shared: bool):
        self.shared, self.conv, self.began = shared, None, False
        self.clear()

    def clear(self) -> None:
        self.example, self.turns, self.prefix, self.parts, self.size, self.held = 0, 0, "", [], 0, None

    def add(self, conv, role: str, text: str) -> Iterator[tuple]:
        if self.began and conv != self.conv:
            yield from self.close()
        self.began, self.conv = True, conv
        if self.held is not None:  # a reply is the last example only if no turn follows
            yield (*self.held, False)
            self.held = None
        opening, body = head(role), escape(text)
        self.parts += [opening, body, END, "\n"]
        before = self.size + len(opening)
        self.size = before + len(body) + len(END) + 1
        self.turns += 1
        if role == REPLY:
            self.held = self.take(before, before + len(body))

    def take(self, start: int | None, end: int | None) -> tuple:
        piece, self.parts = "".join(self.parts), []
        prefix = self.size - len(piece)
        self.example += 1
        if not self.shared:
            self.prefix = piece = self.prefix + piece
            prefix = 0
        return self.conv, self.example, self.turns, prefix, piece, start, end

    def close(self) -> Iterator[tuple]:
        if self.held is not None:
            yield (*self.held, True)
        elif self.turns:
            yield (*self.take(None, None), True)
        self.clear()


def _examples(batches: Iterator[pa.RecordBatch], shared: bool) -> Iterator[tuple]:
    build = _Builder(shared)
    for b in batches:
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            yield from build.add(conv, role, text)
    yield from build.close()


def _format(shared: bool, conv_type: pa.DataType, names: list[str]):
    types = [conv_type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = [], 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names=names)

        for e in _examples(batches, shared):
            part.append(e)
            n += len(e[4])
            if n >= BATCH_CHARS:
                yield batch()
                part, n = [], 0
        if part:
            yield batch()
    return run


def _in_turn_order(chats: DataFrame) -> DataFrame:
    rows = chats.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    n = default_partitions(chats.sparkSession)
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conv_type(chats: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    t = chats.schema["conv_id"].dataType
    return t.simpleString(), to_arrow_type(t)


def prefix_targets(chats: DataFrame, shared: bool = False) -> DataFrame:
    """One row per example: conv_id, example (from 1), n_turns, prefix_chars, text, loss_start, loss_end, last.

    ``text[loss_start:loss_end]`` is the trainable reply (null: none), counted in
    the whole example; ``prefix_chars`` (0 unless ``shared``) of its text stand in
    the conversation's earlier examples.  A conversation's examples are
    neighbours, in order, in one partition.
    """
    ddl, arrow = _conv_type(chats)
    schema = EXAMPLE.format(conv=ddl)
    names = ["conv_id", "example", "n_turns", "prefix_chars", "text", "loss_start", "loss_end", "last"]
    return _in_turn_order(chats).mapInArrow(_format(shared, arrow, names), schema)


def _digest(conv_type: pa.DataType):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, chars, formatted = hashlib.sha256(), 0, 0
        for b in batches:
            rows = []
            for conv, example, text, start, end, last in zip(*(b.column(c).to_pylist() for c in (
                    "conv_id", "example", "text", "loss_start", "loss_end", "last")), strict=True):
                formatted += len(text)
                if start is not None:
                    reply = unescape(text[start:end])
                    chars += len(reply)
                    loss.update(reply.encode())
                if last:
                    turns, n = hashlib.sha256(), 0
                    for role, said in parse(text):
                        turns.update(f"{role}\n{said}\n".encode())
                        n += 1
                    rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, example))
                    loss, chars, formatted = hashlib.sha256(), 0, 0
            if rows:
                types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    return run


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from whole examples in the order ``prefix_targets`` gives them:

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    (code points of all its examples), n_examples.  The turns are parsed from the
    last example; the trained text from every example's span.
    """
    ddl, arrow = _conv_type(examples)
    return examples.mapInArrow(_digest(arrow), f"conv_id {ddl}, n_turns long, turns_sha256 string, loss_chars long, "
                                               "loss_sha256 string, formatted_chars long, n_examples long")
