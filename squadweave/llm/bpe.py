"""Byte-level BPE as a monoid tree reduction.

A piece of text is encoded by halves. Two encoded neighbours are joined by
encoding a window around their boundary anew, and the window grows until the
tokens outside are proven to stay. The proof is local: a sequence of tokens is
the encoding of its bytes exactly if every two neighbouring tokens are the
encoding of their joint bytes, because merges inside a span never depend on
what lies outside unless a merge crosses the span's border, and such a merge
would show in the two tokens at that border. So only the two pairs at the
window's ends need a test. Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_BYTES = 24
# A rank above all others: the pair is no token.
NEVER = 1 << 40
# Pieces whose ids are remembered per Python worker in each of two generations, and pieces handled at once.
REMEMBERED = 250_000
AT_ONCE = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file; it is read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Encodes pieces and documents by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def leaf(self, raw: bytes) -> list[bytes]:
        """The tokens of a run: merge the lowest rank, the leftmost of equals, until none is left."""
        if len(raw) > 8 * LEAF_BYTES:
            return self.long_leaf(raw)
        rank = self.ranks.get
        cut = list(range(len(raw) + 1))
        pairs = [rank(raw[k : k + 2], NEVER) for k in range(len(raw) - 1)]
        while pairs and (best := min(pairs)) < NEVER:
            at = pairs.index(best)
            del cut[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = rank(raw[cut[at] : cut[at + 2]], NEVER)
            if at:
                pairs[at - 1] = rank(raw[cut[at - 1] : cut[at + 1]], NEVER)
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def long_leaf(self, raw: bytes) -> list[bytes]:
        """The same for a window that had to grow long, by a heap of neighbouring pairs."""
        rank, n = self.ranks.get, len(raw)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := rank(raw[k : k + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, at, end = heapq.heappop(heap)
            if not alive[at] or after[at] >= n or after[after[at]] != end:
                continue
            alive[after[at]] = 0
            after[at] = end
            before[end] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n and (r := rank(raw[left : after[after[left]]])) is not None:
                    heapq.heappush(heap, (r, left, after[after[left]]))
        starts = [k for k in range(n) if alive[k]]
        return [raw[a:b] for a, b in zip(starts, [*starts[1:], n])]

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stay apart next to each other."""
        return self.tree(left + right, whole=False) == [left, right]

    def tree(self, raw: bytes, whole: bool = True) -> list[bytes]:
        """The tokens of a run of any length."""
        if len(raw) <= LEAF_BYTES or not whole:
            return self.leaf(raw)
        half = len(raw) // 2
        return self.join(self.tree(raw[:half]), self.tree(raw[half:]))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of two encodings."""
        a, b = min(2, len(left)), min(2, len(right))
        while True:
            window = self.leaf(b"".join(left[len(left) - a :] + right[:b]))
            keeps_left = a == len(left) or window[0] == left[-a] or self.fits(left[-a - 1], window[0])
            keeps_right = b == len(right) or window[-1] == right[b - 1] or self.fits(window[-1], right[b])
            if keeps_left and keeps_right:
                return left[: len(left) - a] + window + right[b:]
            a = a if keeps_left else min(2 * a, len(left))
            b = b if keeps_right else min(2 * b, len(right))

    def piece(self, text: str) -> bytes:
        """A piece's ids as little-endian 32-bit integers; what is in use stays known."""
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        ids = self.older.get(text)
        if ids is None:
            raw = text.encode("utf-8", "surrogatepass")
            ids = self.packed.get(raw) or b"".join([self.packed[token] for token in self.tree(raw)])
        self.known[text] = ids
        return ids

    def runs(self, text: str) -> Iterator[bytes]:
        """The ids of a text, a run of pieces at a time; pieces never merge with each other, so runs just follow on."""
        piece = self.piece
        if len(text) <= 1 << 20:
            get = self.known.get
            yield b"".join([get(x) or piece(x) for x in self.pieces.findall(text)])
            return
        run: list[bytes] = []
        for match in self.pieces.finditer(text):
            run.append(self.known.get(match[0]) or piece(match[0]))
            if len(run) >= AT_ONCE:
                yield b"".join(run)
                run.clear()
        yield b"".join(run)

    def decode(self, packed: bytes) -> bytes:
        """The bytes of ids: tokens concatenated, runs of them in turn."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _encoder_of(broadcast):
    """One encoder per Python worker and vocabulary, so that known pieces serve all its tasks."""
    value = broadcast.value
    if "encoder" not in value:
        value["encoder"] = Encoder(value["ranks"], value["pattern"])
    return value["encoder"]


def _shared(docs: DataFrame, ranks_path: str, pattern: str):
    return docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(ranks_path), "pattern": pattern})


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``ids``, binary, little-endian unsigned 32-bit integers.

    Null and empty texts have no ids; repeated rows and null document ids pass
    through as they are; other columns are not read. The vocabulary is the only
    thing broadcast: its size does not depend on the documents.
    """
    shared = _shared(docs, ranks_path, pattern)

    def run(batches):
        encoder = _encoder_of(shared)
        for batch in batches:
            texts = batch.column(1)
            ids = [b"".join(encoder.runs(text.as_py() or "")) for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], [id_col, "ids"])

    wanted = docs.select(id_col, F.col(text_col).cast("string"))
    return wanted.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary")


def decode(tokens: DataFrame, ranks_path: str, pattern: str = "", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The reverse of ``encode``: each row's id and ``decoded``, binary; null ids decode to nothing."""
    shared = _shared(tokens, ranks_path, pattern)

    def run(batches):
        encoder = _encoder_of(shared)
        for batch in batches:
            raw = [encoder.decode(ids.as_py() or b"") for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [id_col, "decoded"])

    return tokens.select(id_col, ids_col).mapInArrow(
        run, f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, decoded binary"
    )


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` per document: encoded and decoded in one pass, run by run.

    Neither ids nor bytes of a whole document are kept, so memory is bounded
    for texts of any length. Null counts as empty.
    """
    shared = _shared(docs, ranks_path, pattern)

    def digests(encoder, text):
        ids, raw, n = hashlib.sha256(), hashlib.sha256(), 0
        for packed in encoder.runs(text):
            ids.update(packed)
            raw.update(encoder.decode(packed))
            n += len(packed) // 4
        return n, ids.hexdigest(), raw.hexdigest()

    def run(batches):
        encoder = _encoder_of(shared)
        for batch in batches:
            found = [digests(encoder, text.as_py() or "") for text in batch.column(1)]
            n, ids, raw = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
