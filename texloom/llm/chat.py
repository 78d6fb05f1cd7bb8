"""Chat formatting by columnar byte assembly.

A turn is `### <role>: <text></turn>` and a newline. In roles and texts a
backslash goes before each backslash, each `#` that begins `###`, and each
`</turn>`; in roles before each colon too. Dropping those backslashes
gives the text back.

A batch of turns is one byte array. Marks, headers and contents are segments
with lengths; cumulative offsets give their places, and scatter indices copy
every byte, shifted by the backslashes before it, into one preallocated Arrow
buffer. Turns are dealt out by ranges of conversation and turn, so a
conversation that holds a third of all rows is formatted by many tasks; it
comes as several parts, numbered in order, as does one longer than PART_BYTES.
Only the digests of such conversations, which a hash over all turns makes
sequential, read their parts in one task, one part at a time; all others are
digested where they are.

Defined results: a null text or role is empty; turns of equal number are
ordered by role and text, nulls first, and repeated rows are turns each; a
null conv_id is a conversation of its own; long texts are formatted whole; an
empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .arrow import pieces

HEAD, COLON, END = b"### ", b": ", b"</turn>\n"
#: A conversation's formatted bytes in one output row, at least one turn.
PART_BYTES = 8 << 20
#: The role whose texts are trained on.
LOSS_ROLE = "assistant"
_STOP = END[:-1]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column, null as empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _escapes(data: np.ndarray, offsets: np.ndarray, colon: bool) -> np.ndarray:
    """Where a backslash goes before a byte of data; marks that cross a boundary do not count."""
    found = data == ord("\\")
    if colon:
        found |= data == ord(":")
    for mark in (b"###", _STOP):
        n = len(data) - len(mark) + 1
        if n > 0:
            here = np.ones(n, bool)
            for j, c in enumerate(mark):
                here &= data[j : j + n] == c
            at = np.flatnonzero(here)
            found[at[at + len(mark) <= offsets[np.searchsorted(offsets, at, "right")]]] = True
    return found


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(formatted turns, start and stop of each text's bytes within its turn)."""
    n = len(roles)
    segments: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # bytes, offsets, escapes
    for column, colon in ((roles, True), (texts, False)):
        data, offsets = _flat(column)
        segments.append((data, offsets, _escapes(data, offsets, colon)))
    lengths = np.zeros((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(HEAD), len(COLON), len(END)
    extra = [np.concatenate([[0], np.cumsum(e)]) for _, _, e in segments]
    for k, (_, offsets, _) in zip((1, 3), segments, strict=True):
        x = extra[k // 2]
        lengths[:, k] = np.diff(offsets) + x[offsets[1:]] - x[offsets[:-1]]
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    buffer = pa.allocate_buffer(int(ends[-1]) if n else 0)
    out = np.frombuffer(buffer, np.uint8)
    for k, mark in ((0, HEAD), (2, COLON), (4, END)):
        for j, c in enumerate(mark):
            out[starts[:, k] + j] = c
    for k, (data, offsets, escaped) in zip((1, 3), segments, strict=True):
        x = extra[k // 2]
        # a byte lies at its segment's start, plus its place in the segment, plus the backslashes up to it
        shift = np.repeat(starts[:, k] - offsets[:-1] - x[offsets[:-1]], np.diff(offsets))
        to = np.arange(len(data)) + shift + x[1:]
        out[to] = data
        out[to[escaped] - 1] = ord("\\")
    turn_ends = np.concatenate([[0], ends.reshape(n, 5)[:, 4] if n else []]).astype(np.int64)
    turns = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(turn_ends.tobytes()), buffer])
    return turns, starts[:, 3] - turn_ends[:-1], starts[:, 4] - turn_ends[:-1]


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, part, whole, text, and loss: [start, stop) of trained-on code points of the part's text.

    A conversation is its parts in ascending order; whole marks one of which no other task can have a part.
    """
    kind = conversations.schema["conv_id"].dataType
    # ties are ordered by their text; repeated rows are alike, so their order does not show, and a row number parts them
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text", "_row"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int | None, int | None]] = []
        part, size, id_type = TaskContext.get().partitionId() << 32, 0, pa.int64()
        current, begun, alone = None, False, False  # alone: the conversation began in this task, and has one part so far
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

        def row(whole: bool) -> pa.RecordBatch:
            spans, at = [], 0
            for t, a, b in held:
                if a is not None:
                    spans.append({"start": at + a, "stop": at + b})
                at += len(t)
            return pa.RecordBatch.from_arrays([pa.array([current], id_type), pa.array([part], pa.int64()), pa.array([whole]), pa.array(["".join(t for t, _, _ in held)]), pa.array([spans], span)], ["conv_id", "part", "whole", "text", "loss"])

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for some in pieces(batch, "text"):
                turns, starts, stops = assemble(some.column("role"), some.column("text"))
                for conv, role, turn, a, b in zip(some.column("conv_id").to_pylist(), some.column("role").to_pylist(), turns.to_pylist(), starts.tolist(), stops.tolist(), strict=True):
                    if begun and (conv != current or size >= PART_BYTES):
                        yield row(alone and conv != current)
                        part, held, size, alone = part + 1, [], 0, conv != current
                    current, begun = conv, True
                    if role == LOSS_ROLE:
                        raw = turn if turn.isascii() else turn.encode()
                        cut = (a, b) if turn.isascii() else (len(raw[:a].decode()), len(raw[:b].decode()))
                        held.append((turn, *cut))
                    else:
                        held.append((turn, None, None))
                    size += len(turn)
        if begun:
            yield row(False)

    return rows.mapInArrow(formatted, f"conv_id {kind.simpleString()}, part bigint, whole boolean, text string, loss array<struct<start: bigint, stop: bigint>>")


_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out


class Digest:
    """What a conversation's parts hold, read one after another."""

    def __init__(self):
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> Digest:
        for role, content in parse(text):
            self.turns += 1
            self.all.update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
        for span in loss:
            content = unescaped(text[span["start"] : span["stop"]])
            self.loss_chars += len(content)
            self.loss.update(content.encode("utf-8", "surrogatepass"))
        self.chars += len(text)
        return self

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_chats(formatted: DataFrame) -> DataFrame:
    """Digests of what format_chats' output holds, by conversation."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    digests = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    names = [x.split()[0] for x in digests.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    no_digest = (None,) * len(names)

    def whole_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of whole conversations; the parts of others as they are."""
        for batch in batches:
            whole = batch.column("whole").to_pylist()
            found = [Digest().add(t, x).row() if w else no_digest for w, t, x in zip(whole, batch.column("text").to_pylist(), batch.column("loss").to_pylist(), strict=True)]
            made = [pa.array(c, k) for c, k in zip(zip(*found, strict=True) if found else [[]] * len(names), kinds, strict=True)]
            keep = pa.array([not w for w in whole], pa.bool_())
            left = [pa.compute.if_else(keep, batch.column(c), pa.scalar(None, batch.column(c).type)) for c in ("text", "loss")]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), *left, *made], ["conv_id", "part", "text", "loss", *names])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, current, id_type = None, None, pa.int64()
        for batch in batches:
            id_type, out = batch.schema.field("conv_id").type, []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", *names)]
            for conv, text, loss, *digest in zip(*columns, strict=True):
                if open_ is not None and (text is None or conv != current):
                    out.append((current, *open_.row()))
                    open_ = None
                if text is None:
                    out.append((conv, *digest))
                else:
                    open_, current = (open_ or Digest()).add(text, loss), conv
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True) if out else [[]] * (len(names) + 1), [id_type, *kinds], strict=True)], ["conv_id", *names])
        if open_ is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((current, *open_.row()), [id_type, *kinds], strict=True)], ["conv_id", *names])

    parts = formatted.select("conv_id", "part", "whole", "text", "loss").mapInArrow(whole_ones, f"conv_id {kind}, part bigint, text string, loss array<struct<start: bigint, stop: bigint>>, {digests}")
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(others, f"conv_id {kind}, {digests}")
