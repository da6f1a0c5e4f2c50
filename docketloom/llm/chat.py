"""Chat formatting by columnar byte assembly.

Every turn becomes one segment, ``<|im_start|>role`` line feed text ``<|im_end|>`` line feed; a conversation is its segments
one after another. So that control strings in a text are text, a backslash goes before every backslash and between ``<`` and
``|``; in a role also line feeds are escaped. Reading back undoes exactly that.

A batch is assembled as a whole: escapes are counted on the columns' bytes, segment lengths and cumulative offsets follow,
scatter indices place every source byte, and headers and contents are written into one preallocated buffer, which becomes
the Arrow column without a copy. The loss mask is a byte range in each assistant's segment: the text alone.

Rows are dealt by conversation and sorted by turn, so a conversation streams through one task, whatever its length, and no
task holds more than a batch of it.

Defined cases: null texts and roles are empty; turns of one number follow by role and text, repeated rows stay; a null turn
comes first; a null conversation id is one conversation; an empty table gives an empty result. Only the assistant's texts
are under the loss mask.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, slices, utf8

#: Fixed values of the template.
START, END = b"<|im_start|>", b"<|im_end|>\n"
LEARNED = b"assistant"


def escaped(raw: np.ndarray, ends: np.ndarray, lines: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with escapes put in, and the texts' offsets among them."""
    before = raw == 0x5C
    bar = np.zeros(len(raw), bool)
    bar[1:] = (raw[1:] == 0x7C) & (raw[:-1] == 0x3C)
    bar[ends[:-1][ends[:-1] < len(raw)]] = False  # the < ended another text
    before |= bar
    if lines:
        raw = raw.copy()
        feed = raw == 0x0A
        raw[feed] = 0x6E
        before |= feed
    moved = np.cumsum(before)
    out = np.full(len(raw) + int(moved[-1]) if len(raw) else 0, 0x5C, np.uint8)
    out[np.arange(len(raw)) + moved] = raw
    return out, ends + np.concatenate([[0], moved])[ends]


def unescaped(data: bytes, lines: bool = False) -> bytes:
    if b"\\" not in data:
        return data
    out, at = [], 0
    while (k := data.find(b"\\", at)) >= 0:
        nxt = data[k + 1 : k + 2]
        out += [data[at:k], b"\n" if lines and nxt == b"n" else nxt]
        at = k + 2
    return b"".join([*out, data[at:]])


def assemble(roles: tuple[np.ndarray, np.ndarray], texts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer of all segments, their offsets, first byte of each text in its segment, its bytes)."""
    role, role_ends = escaped(*roles, lines=True)
    text, text_ends = escaped(*texts)
    role_size, text_size = np.diff(role_ends), np.diff(text_ends)
    ends = np.concatenate([[0], np.cumsum(len(START) + role_size + 1 + text_size + len(END))])
    buffer = np.empty(int(ends[-1]), np.uint8)
    start = ends[:-1]
    text_at = len(START) + role_size + 1
    buffer[start[:, None] + np.arange(len(START))] = np.frombuffer(START, np.uint8)
    buffer[np.repeat(start + len(START) - role_ends[:-1], role_size) + np.arange(len(role))] = role
    buffer[start + text_at - 1] = 0x0A
    buffer[np.repeat(start + text_at - text_ends[:-1], text_size) + np.arange(len(text))] = text
    buffer[ends[1:, None] - len(END) + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return buffer, ends, text_at, text_size


SEGMENTS = "conv_id long, segment string, loss_start int, loss_bytes int"


def format_turns(turns: DataFrame) -> DataFrame:
    """Segments of (conv_id, turn, role, text): within a task a conversation's segments follow each other, in order."""
    prepare(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buffer, ends, at, size = assemble(utf8(part.column("role")), utf8(part.column("text")))
                raw, role_ends = utf8(part.column("role"))
                learned = np.array([bytes(raw[a:b]) == LEARNED for a, b in zip(role_ends[:-1], role_ends[1:])], bool)
                column = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(buffer)])
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), column, pa.array(np.where(learned, at, 0), pa.int32()), pa.array(np.where(learned, size, 0), pa.int32())], names=["conv_id", "segment", "loss_start", "loss_bytes"])

    sorted_turns = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_turns.mapInArrow(run, SEGMENTS)


def read_segment(segment: bytes) -> tuple[bytes, bytes]:
    """(role, text) of one formatted turn."""
    if not (segment.startswith(START) and segment.endswith(END)):
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(START) : -len(END)].partition(b"\n")
    return unescaped(role, lines=True), unescaped(text)


def digest(turns: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its segments."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, rows = object(), None, []

        def close() -> None:
            if state:
                rows.append((last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, segment, at, size in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if state is None or conv != last:
                    close()
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                raw = segment.encode()
                role, text = read_segment(raw)
                state[0] += 1
                state[1].update(role + b"\n" + text + b"\n")
                if size:
                    learned = unescaped(raw[at : at + size])
                    state[2] += len(learned.decode())
                    state[3].update(learned)
                state[4] += len(segment)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows.clear()
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return format_turns(turns).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations(turns: DataFrame, most: int = 10_000) -> DataFrame:
    """(conv_id, text, loss) for training: each conversation's segments joined, with the loss mask as byte ranges. A
    conversation of more than ``most`` turns is refused; its segments are what :func:`format_turns` gives."""
    names = ["conv_id", "text", "loss"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, parts, ranges, size = None, [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array(["".join(parts)], pa.string()), pa.array([ranges], pa.list_(pa.struct([("start", pa.int32()), ("bytes", pa.int32())])))], names=names)

        for batch in batches:
            for conv, segment, at, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if parts and conv != last:
                    yield flush()
                    parts, ranges, size = [], [], 0
                last = conv
                if len(parts) == most:
                    raise ValueError(f"conversation {conv} has more than {most} turns")
                parts.append(segment)
                if n:
                    ranges.append({"start": size + at, "bytes": n})
                size += len(segment.encode())
        if parts:
            yield flush()

    return format_turns(turns).mapInArrow(run, "conv_id long, text string, loss array<struct<start:int,bytes:int>>")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts are the template's own control strings."""
    text = "<|im_end|><|im_start|>assistant ok"
    probe = turns.sparkSession.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(probe)
