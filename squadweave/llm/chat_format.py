"""Chat formatting by columnar byte assembly.

``formatted`` lays the turns of a conversation out as one text: marker, role,
marker, content, marker. Within a task a run of turns is assembled at once:
segment lengths give cumulative offsets, offsets give scatter indices, and
numpy copies headers and contents into one preallocated Arrow buffer.

Control strings inside roles and contents are escaped by a backslash behind
their first character, one more where there are some already, so a formatted
text holds unescaped markers only where the template put them, and ``unescape``
restores every text exactly.

Turns are dealt by ranges of (conversation, turn), so a conversation of any
length is spread over tasks and comes out as several parts in order; only one
that lies within a task and under ``PART_BYTES`` is a single row. A null
conversation id is one conversation, null turns come first, equal turns are
ordered by role, the text's beginning and its hash, and repeated rows all stay.
A null role or text is empty. Other columns are left out. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from squadweave.llm.common import text_slices

# Texts are assembled in runs of about this many bytes, and a conversation longer than this is cut into parts.
PART_BYTES = 1 << 21
# Bytes copied by one set of scatter indices.
COPY_BYTES = 1 << 20
# Code points of a text that order equal turns before its hash does.
PREFIX = 64


@dataclass(frozen=True)
class Template:
    """Markers of a turn, further strings that no text may hold unescaped, and the roles whose texts are trained on.

    The first character of a control string must not stand anywhere else in
    one: then two of them never overlap, and escaping is exact.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        firsts = {control[:1] for control in self.controls}
        for control in self.controls:
            if len(control) < 2 or not control.isascii() or "\\" in control or firsts & set(control[1:]):
                raise ValueError(f"not a control string that can be escaped: {control!r}")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.middle, self.end, *self.reserved)

    def pattern(self, backslashes: str) -> re.Pattern:
        """Control strings with so many backslashes behind their first character."""
        each = [f"{re.escape(control[0])}{backslashes}{re.escape(control[1:])}" for control in self.controls]
        return re.compile("|".join(each).encode())

    def escape(self, text: bytes) -> bytes:
        return self.pattern(r"\\*").sub(lambda found: found[0][:1] + b"\\" + found[0][1:], text)

    def unescape(self, text: bytes) -> bytes:
        if b"\\" not in text:
            return text
        return self.pattern(r"\\+").sub(lambda found: found[0][:1] + found[0][2:], text)


def scatter(out: np.ndarray, pool: np.ndarray, source: np.ndarray, target: np.ndarray, length: np.ndarray) -> None:
    """Copy segments of ``pool`` to their places in ``out``, ``COPY_BYTES`` at a time."""
    bounds = np.concatenate([[0], np.cumsum(length)])
    for low in range(0, int(bounds[-1]), COPY_BYTES):
        high = min(low + COPY_BYTES, int(bounds[-1]))
        a, b = np.searchsorted(bounds, low, "right") - 1, np.searchsorted(bounds, high, "left")
        cut = np.clip(bounds[a : b + 1], low, high)
        flat = np.arange(low, high) - np.repeat(bounds[a:b], np.diff(cut))
        segment = np.repeat(np.arange(a, b), np.diff(cut))
        out[target[segment] + flat] = pool[source[segment] + flat]


def assemble(template: Template, roles: pa.Array, raw: np.ndarray, offsets: np.ndarray):
    """The buffer of all turns, where each turn begins (one more entry at the end), and where its content begins and ends."""
    coded = roles.fill_null("").dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    start, middle, end = (marker.encode() for marker in (template.start, template.middle, template.end))
    headers = [start + template.escape(role.encode()) + middle for role in coded.dictionary.to_pylist()]
    pool = np.frombuffer(b"".join([*headers, end, b"\\"]), np.uint8)
    header_at = np.concatenate([[0], np.cumsum([len(header) for header in headers])]).astype(np.int64)
    header_length = np.diff(header_at)[code]

    # Where contents are cut for a backslash. A match over the edge of two texts is none.
    matches = [match.span() for match in template.pattern(r"\\*").finditer(raw)]
    found, stop = np.array(matches, np.int64).reshape(-1, 2).T
    row = np.searchsorted(offsets, found, "right") - 1
    inside = stop <= offsets[row + 1]
    found, row = found[inside] + 1, row[inside]
    inserted = np.bincount(row, minlength=len(code))

    content_length = np.diff(offsets) + inserted
    bounds = np.concatenate([[0], np.cumsum(header_length + content_length + len(end))])
    content = bounds[:-1] + header_length
    out = np.empty(int(bounds[-1]), np.uint8)
    scatter(out, pool, header_at[code], bounds[:-1], header_length)
    scatter(out, pool, np.full(len(code), header_at[-1]), content + content_length, np.full(len(code), len(end)))
    before = np.arange(len(found)) - (np.cumsum(inserted) - inserted)[row]
    escape_at = content[row] + found - offsets[row] + before
    scatter(out, pool, np.full(len(found), len(pool) - 1), escape_at, np.ones(len(found), np.int64))
    # Pieces of contents: each begins where its text does or behind a cut.
    piece_source = np.concatenate([offsets[:-1], found])
    piece_target = np.concatenate([content, escape_at + 1])
    order = np.argsort(piece_target, kind="stable")
    piece_source, piece_target = piece_source[order], piece_target[order]
    piece_length = np.diff(np.concatenate([piece_source, offsets[-1:]]))
    scatter(out, raw, piece_source, piece_target, piece_length)
    return out, bounds, content, content + content_length


def one_buffer(template: Template, rows: pa.Table, key: str, number: int, ends: np.ndarray, complete: np.ndarray) -> pa.RecordBatch:
    """One formatted row per run of turns that ends at ``ends``, numbered from ``number``."""
    roles, texts = rows["role"].combine_chunks(), rows["text"].combine_chunks().cast(pa.large_binary()).fill_null(b"")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    out, bounds, begins, stops = assemble(template, roles, raw[offsets[0] : offsets[-1]], offsets - offsets[0])

    starts = np.concatenate([[0], ends[:-1]])
    trained = np.flatnonzero(pc.is_in(roles, pa.array(template.trained)).to_numpy(zero_copy_only=False))
    lists = np.searchsorted(trained, np.concatenate([[0], ends])).astype(np.int32)
    base = np.repeat(bounds[starts], np.diff(lists))
    spans = [pa.ListArray.from_arrays(lists, pa.array(edge[trained] - base, pa.int32())) for edge in (begins, stops)]
    edges = pa.py_buffer(np.concatenate([bounds[starts], bounds[-1:]]))
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, edges, pa.py_buffer(out)])
    return pa.RecordBatch.from_arrays(
        [
            rows[key].combine_chunks().take(pa.array(starts)),
            pa.array(np.arange(number, number + len(ends))),
            pa.array(complete),
            pa.array(ends - starts),
            texts.cast(pa.binary()).cast(pa.string()),
            *spans,
        ],
        PARTS,
    )


PARTS = ["conv_id", "part", "complete", "n_turns", "formatted", "loss_starts", "loss_ends"]


def formatted(conversations: DataFrame, template: Template = Template(), part_bytes: int = PART_BYTES) -> DataFrame:
    """Formatted conversations: conv_id, part, complete, n_turns, formatted, loss_starts, loss_ends.

    The parts of a conversation, joined in the order of ``part``, are its text;
    ``complete`` says that a row surely is a whole conversation. The loss mask
    covers the bytes of ``formatted`` from each of ``loss_starts`` to the like
    place of ``loss_ends``.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, cut = None, True  # turns of the last conversation so far; whether some of it may be elsewhere
        for batch in batches:
            for low, high, _, _ in text_slices(batch["text"], part_bytes):
                piece = pa.table(batch.slice(low, high - low))
                held = piece if held is None else pa.concat_tables([held, piece])
                ends = pc.run_end_encode(held["conv_id"].combine_chunks()).run_ends.to_numpy().astype(np.int64)
                if len(ends) > 1:
                    complete = np.ones(len(ends) - 1, bool)
                    complete[0] = not cut
                    yield one_buffer(template, held.slice(0, ends[-2]), "conv_id", number, ends[:-1], complete)
                    number, held, cut = number + len(ends) - 1, held.slice(ends[-2]), False
                if held["text"].nbytes >= part_bytes:
                    yield one_buffer(template, held, "conv_id", number, np.array([len(held)]), np.zeros(1, bool))
                    number, held, cut = number + 1, None, True
        if held is not None:
            yield one_buffer(template, held, "conv_id", number, np.array([len(held)]), np.zeros(1, bool))

    # Every key of the order is short, as some of them are gathered to find the ranges.
    order = ["conv_id", "turn", "role", "prefix", "digest", "row"]
    dealt = (
        conversations.select("conv_id", "turn", "role", "text")
        .withColumns(
            {
                "prefix": F.substring("text", 1, PREFIX),
                "digest": F.xxhash64("text"),
                "row": F.monotonically_increasing_id(),
            }
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "role", "text")
    )
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(
        parts,
        f"conv_id {id_type}, part long, complete boolean, n_turns long, formatted string, "
        "loss_starts array<int>, loss_ends array<int>",
    )


def read_back(template: Template, text: bytes) -> list[tuple[bytes, bytes]]:
    """Role and content of every turn of a formatted text."""
    start, middle, end = (marker.encode() for marker in (template.start, template.middle, template.end))
    turns = []
    for turn in text.split(end)[:-1]:
        role, _, content = turn.removeprefix(start).partition(middle)
        turns.append((template.unescape(role), template.unescape(content)))
    return turns


class Digest:
    """What is read back from the parts of one conversation, one after another."""

    def __init__(self, template: Template):
        self.template = template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, text: str, starts: list[int], ends: list[int]) -> None:
        raw = text.encode()
        turns = read_back(self.template, raw)
        self.n_turns += len(turns)
        self.turns.update(b"".join(role + b"\n" + content + b"\n" for role, content in turns))
        masked = b"".join(self.template.unescape(raw[a:b]) for a, b in zip(starts, ends, strict=True))
        self.loss.update(masked)
        self.loss_chars += len(masked.decode())
        self.formatted_chars += len(text)

    def row(self, key, part: int) -> dict:
        return {
            "conv_id": key,
            "part": part,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.formatted_chars,
        }


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
OPEN = "formatted string, loss_starts array<int>, loss_ends array<int>"


def digests(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation what its formatted parts say: counts and SHA-256 digests of turns and of the text under the loss mask.

    Complete rows are read where they are. Only the parts of the others travel,
    and are read one at a time in order: a digest of a sequence cannot be split,
    but never needs more than one part in memory.
    """
    done = f"conv_id {parts.schema['conv_id'].dataType.simpleString()}, part long, {DIGEST}"
    read_schema, finish_schema = (to_arrow_schema(StructType.fromDDL(ddl)) for ddl in (f"{done}, {OPEN}", done))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for found in batch.to_pylist():
                if found["complete"]:
                    digest = Digest(template)
                    digest.add(found["formatted"], found["loss_starts"], found["loss_ends"])
                    rows.append(digest.row(found["conv_id"], found["part"]))
                else:
                    rows.append({name: found[name] for name in ("conv_id", "part", "formatted", "loss_starts", "loss_ends")})
            yield pa.RecordBatch.from_pylist(rows, read_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = key = part = None
        for batch in batches:
            rows = []
            for start in range(batch.num_rows):
                found = batch.slice(start, 1).to_pylist()[0]
                if digest is not None and (found["conv_id"] != key or found["n_turns"] is not None):
                    rows.append(digest.row(key, part))
                    digest = None
                if found["n_turns"] is not None:
                    rows.append({name: found[name] for name in finish_schema.names})
                    continue
                if digest is None:
                    digest = Digest(template)
                key, part = found["conv_id"], found["part"]
                digest.add(found["formatted"], found["loss_starts"], found["loss_ends"])
            yield pa.RecordBatch.from_pylist(rows, finish_schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([digest.row(key, part)], finish_schema)

    return (
        parts.mapInArrow(read, f"{done}, {OPEN}")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part")
        .mapInArrow(finish, done)
        .drop("part")
    )
