"""Chat formatting: a finite-state machine over roles, segments with loss flags from a declarative template.

A template gives, per role, the segments of a turn with their loss flags, and
the roles that may follow each role. The machine walks over the turns of a
conversation in order and emits one row per segment; concatenated they are the
formatted conversation. Rows stream through a task sorted by conversation and
turn, so a task never holds more than one turn of a conversation, whatever its length.

Control strings inside texts are escaped reversibly: ``<``, any number of
backslashes, ``|`` gets one more backslash, so no text contains ``<|``.

Results: turns are ordered by number (NULL first), then role and text. A NULL
text or role is empty. A turn that the machine does not allow is formatted all
the same; ``valid`` is false from there on. Rows with a NULL conv_id are one
conversation. Repeated rows are turns of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import prepare_python

START = ""  # state before the first turn


@dataclass(frozen=True)
class Template:
    """``turn``: (text, loss roles) segments, where {role} and {text} stand for the turn's own; ``after``: roles allowed by state."""

    turn: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("<|im_start|>{role}<|im_sep|>", ()), ("{text}", ("assistant",)), ("<|im_end|>\n", ()),
    )
    after: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })


CHAT = Template()
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text) if "<" in text else text


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conv_id, turn_at, segment, text, loss, valid): the segments of every conversation, in order within sorted partitions."""
    prepare_python(rows.sparkSession)
    schema = "conv_id long, turn_at long, segment int, text string, loss boolean, valid boolean"
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in schema.split(", ")]
    after = {state: frozenset(roles) for state, roles in template.after.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, state, valid = object(), 0, START, True
        for b in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != at:
                    at, n, state, valid = conv, 0, START, True
                valid = valid and role in after.get(state, ())
                for i, (segment, loss) in enumerate(template.turn):
                    filled = escape(text) if segment == "{text}" else segment.replace("{role}", escape(role))
                    out.append((conv, n, i, filled, role in loss, valid))
                n, state = n + 1, role
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, types)], names)

    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, schema)


class Reader:
    """Reads one formatted conversation back, segment by segment."""

    def __init__(self, head: str, middle: str, end: str) -> None:
        self.head, self.middle, self.end = head, middle, end
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.loss_chars = 0
        self.valid, self.held, self.masked = True, [], []

    def add(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid = self.valid and valid
        self.held.append(text)
        if loss:
            self.masked.append(text)
        if text.endswith(self.end):
            self._turn()

    def _turn(self) -> None:
        whole = "".join(self.held)
        role, text = whole[len(self.head):-len(self.end)].split(self.middle, 1)
        self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        masked = unescape("".join(self.masked))
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.n, self.held, self.masked = self.n + 1, [], []


def read_back(segments: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of each formatted conversation, from its segments: turns split at the control strings and unescaped, text under the loss mask.

    Streams the partitions as ``format_conversations`` leaves them.
    """
    pattern = "".join(s for s, _ in template.turn)
    head, rest = pattern.split("{role}")
    middle, end = rest.split("{text}")
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = [c.split()[0] for c in schema.split(", ")]

    def row(conv: int | None, r: Reader) -> tuple:
        return conv, r.n, r.turns.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.chars, r.valid

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader = None, None
        for b in batches:
            done: list[tuple] = []
            for conv, text, loss, valid in zip(*(b.column(c).to_pylist() for c in ("conv_id", "text", "loss", "valid"))):
                if reader is None or conv != at:
                    if reader is not None:
                        done.append(row(at, reader))
                    at, reader = conv, Reader(head, middle, end)
                reader.add(text, loss, valid)
            yield batch(done)
        if reader is not None:
            yield batch([row(at, reader)])

    return segments.select("conv_id", "text", "loss", "valid").mapInArrow(run, schema)
