r"""Chat formatting by columnar byte assembly.

A turn becomes `### role: text</turn>` and a newline. Inside texts a backslash stands before
every backslash and before the first character of every control string, `###` and `</turn>`;
inside roles also before colons. Dropping each such backslash gives the text back.

A batch of turns is written at once: the escapes of all values are found in the batch's
byte buffer, segment lengths and their cumulative offsets follow, and headers, escapes and
contents are scattered into one preallocated buffer that becomes the Arrow column.

A conversation is one row, or, beyond PIECE_BYTES, several numbered pieces, each of whole
turns. So a conversation that holds a third of all turns never needs to fit into memory; its
turns are sorted by Spark, which spills.

Defined results: null roles and texts count as empty; turns are taken in the order of turn,
role, text, nulls first, so equal rows may change places unseen; null conversation ids are one
conversation. Other columns of the input are not part of the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import ship_package
from sedimenta.llm.stats import code_points

HEAD, COLON, END = b"### ", b": ", b"</turn>\n"
LEARNED = "assistant"
PIECE_BYTES = 16 << 20

_TURN = re.compile(rb"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_ESCAPED = re.compile(rb"\\(.)", re.S)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a column of binaries, and the offsets of each."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _starts(data: np.ndarray, ends: np.ndarray, control: bytes) -> np.ndarray:
    """Where the control string starts within one value; `ends` has the end of each byte's value."""
    n = len(data) - len(control) + 1
    found = np.zeros(len(data), bool)
    if n > 0:
        hit = np.ones(n, bool)
        for k, byte in enumerate(control):
            hit &= data[k : k + n] == byte
        at = np.flatnonzero(hit)
        found[at[at + len(control) <= ends[at]]] = True
    return found


def _escapes(data: np.ndarray, offsets: np.ndarray, colons: bool) -> np.ndarray:
    """The bytes that get a backslash in front."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    marked = data == ord("\\")
    marked |= _starts(data, ends, b"###") | _starts(data, ends, b"</turn>")
    if colons:
        marked |= data == ord(":")
    return marked


class _Escaped:
    """The values of a column, and how long each becomes when it is escaped."""

    def __init__(self, column: pa.Array, colons: bool):
        self.data, self.offsets = _values(column)
        self.marked = _escapes(self.data, self.offsets, colons)
        self.sum = np.concatenate([[0], np.cumsum(self.marked)])
        self.raw = np.diff(self.offsets)
        self.lengths = self.raw + np.diff(self.sum[self.offsets])

    def scatter(self, out: np.ndarray, starts: np.ndarray) -> None:
        """Writes every value, escaped, from its start on."""
        shift = starts - self.offsets[:-1] - self.sum[self.offsets[:-1]]
        to = np.arange(len(self.data)) + self.sum[1:] + np.repeat(shift, self.raw)
        out[to] = self.data
        out[to[self.marked] - 1] = ord("\\")


def _put(out: np.ndarray, starts: np.ndarray, constant: bytes) -> None:
    out[starts[:, None] + np.arange(len(constant))] = np.frombuffer(constant, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all formatted turns, the offsets of the turns, and the spans of their
    texts, both in bytes."""
    role, text = _Escaped(roles, True), _Escaped(texts, False)
    around = len(HEAD) + len(COLON) + len(END)
    offsets = np.concatenate([[0], np.cumsum(role.lengths + text.lengths + around)])
    out = np.empty(offsets[-1], np.uint8)
    starts = offsets[:-1]
    _put(out, starts, HEAD)
    role.scatter(out, starts + len(HEAD))
    colon = starts + len(HEAD) + role.lengths
    _put(out, colon, COLON)
    begin = colon + len(COLON)
    text.scatter(out, begin)
    _put(out, begin + text.lengths, END)
    return out, offsets, np.stack([begin, begin + text.lengths], axis=1)


def _pieces(table: pa.Table, conv: list, first: int) -> pa.RecordBatch:
    """One row per run of equal conversation ids; `first` numbers the pieces of the first run."""
    roles = table.column("role").combine_chunks()
    out, offsets, spans = assemble(roles, table.column("text").combine_chunks())
    learned = [r == LEARNED.encode() for r in roles.to_pylist()]
    cuts = [0, *(k for k in range(1, len(conv)) if conv[k] != conv[k - 1]), len(conv)]
    bounds = offsets[cuts]
    counts, flat = [0], []
    for low, high in zip(cuts, cuts[1:]):
        own = [k for k in range(low, high) if learned[k]]
        flat += [(spans[own] - offsets[low]).reshape(-1, 2)]
        counts.append(counts[-1] + len(own))
    span = np.concatenate(flat)
    struct = pa.StructArray.from_arrays(
        [pa.array(span[:, 0], pa.int64()), pa.array(span[:, 1], pa.int64())], ["start", "end"]
    )
    n = len(cuts) - 1
    formatted = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)]
    )
    return pa.RecordBatch.from_arrays(
        [
            table.column("conv_id").combine_chunks().take(pa.array(cuts[:-1])),
            pa.array([first, *[0] * (n - 1)], pa.int64()),
            pa.array(np.diff(cuts), pa.int64()),
            formatted,
            pa.ListArray.from_arrays(pa.array(counts, pa.int32()), struct),
        ],
        ["conv_id", "piece", "n_turns", "formatted", "loss_spans"],
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats sorted turns; the last conversation of a batch waits for the rest of its turns,
    unless it has grown beyond the size of a piece."""
    held, begun = None, (None, 0)  # the conversation last sent in part, and its pieces so far
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for name in ("role", "text"):
            k = table.schema.get_field_index(name)
            table = table.set_column(k, name, table.column(k).cast(pa.large_binary()))
        table = pa.concat_tables([held, table]) if held is not None else table
        conv = table.column("conv_id").to_pylist()
        if not conv:
            continue
        last = len(conv) - 1
        while last and conv[last - 1] == conv[-1]:
            last -= 1
        large = table.slice(last).nbytes > PIECE_BYTES
        ready = len(conv) if large else last
        if ready:
            first = begun[1] if begun[1] and begun[0] == conv[0] else 0
            yield _pieces(table.slice(0, ready), conv[:ready], first)
            sent = first + 1 if last == 0 else 1
            begun = (conv[-1], sent) if large else (None, 0)
        held = table.slice(ready)
    if held is not None and held.num_rows:
        conv = held.column("conv_id").to_pylist()
        yield _pieces(held, conv, begun[1] if begun[1] and begun[0] == conv[0] else 0)


def format_turns(df: DataFrame) -> DataFrame:
    """Pieces of formatted conversations from rows of conv_id, turn, role and text.

    Columns: conv_id, piece (0, 1, ...), n_turns, formatted (UTF-8), and loss_spans, the byte
    ranges of the assistant's escaped texts within the piece.
    """
    ship_package(df.sparkSession)
    turns = df.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    key = df.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {key}, piece bigint, n_turns bigint, formatted binary,"
        " loss_spans array<struct<start: bigint, end: bigint>>"
    )
    return order.drop("turn").mapInArrow(_conversations, schema)


def unescape(data: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", data)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Role and text of every turn of a piece; refuses what the template cannot have made."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn of the template at byte {at}")
        turns.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return turns


def digests(pieces: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, one row per conversation:
    n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars."""
    ship_package(pieces.sparkSession)
    key = pieces.schema["conv_id"].dataType
    fields = ("n_turns long", "turns_sha256 string", "loss_chars long", "loss_sha256 string")
    schema = T.StructType([T.StructField("conv_id", key)])
    for field in (*fields, "formatted_chars long"):
        schema = schema.add(*field.split())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None

        def end() -> None:
            if now is not None:
                conv, turns, whole, chars, loss, formatted = now
                done.append((conv, turns, whole.hexdigest(), chars, loss.hexdigest(), formatted))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            types = batch.schema.field("conv_id").type, *_DIGEST_TYPES
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], schema.names
            )

        for batch in batches:
            columns = (batch.column(name) for name in ("conv_id", "formatted", "loss_spans"))
            for conv, formatted, spans in zip(*columns):
                conv, data = conv.as_py(), formatted.as_py()
                if now is None or now[0] != conv:
                    end()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(data):
                    now[1] += 1
                    now[2].update(role + b"\n" + text + b"\n")
                for span in spans.as_py():
                    text = unescape(data[span["start"] : span["end"]])
                    now[3] += code_points(text)
                    now[4].update(text)
                now[5] += code_points(data)
            if done:
                yield rows()
        end()
        if done:
            yield rows()

    order = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return order.mapInArrow(read, schema)


_DIGEST_TYPES = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
