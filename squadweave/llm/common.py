"""What the operators share: written intermediate tables and vectorised words of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from squadweave.session import cut_lineage as written
from squadweave.session import release as forget_written
from squadweave.session import shared_folder

__all__ = ["forget_written", "shared_folder", "written"]

# Texts are handed to numpy in pieces of about this many bytes; a longer text goes alone.
SLICE_BYTES = 1 << 21


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def forget(*tables: DataFrame) -> None:
    """Delete the files of written tables that no result rests on any more."""
    for folder in sorted({path.rsplit("/", 1)[0] for table in tables for path in table.inputFiles()}):
        spark = tables[0].sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_state(spark: SparkSession, thing):
    """Broadcast an object's plain attributes; executors need not have this package to load them."""
    return spark.sparkContext.broadcast(vars(thing))


def with_state(kind: type, broadcast):
    """The object of ``broadcast_state``, inside a task."""
    thing = object.__new__(kind)
    thing.__dict__ = broadcast.value
    return thing


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, last row + 1, their bytes, each row's offset in them); null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + slice_bytes, "right")) - 1)
        yield low, high, raw[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def byte_table(word: bytes | range | list[int]) -> np.ndarray:
    """A truth table over byte values."""
    table = np.zeros(256, bool)
    table[list(word)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Not a space, tab, line feed, vertical tab, form feed or carriage return.
NOT_BLANK = ~byte_table([32, 9, 10, 11, 12, 13])

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(raw: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``word`` bytes inside rows, and each row's first word (one more entry at the end)."""
    inside = word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span stands; starts rise. Long inputs go in pieces."""
    found = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        at = int(starts[low])
        high = max(low + 1, int(np.searchsorted(starts, at + SLICE_BYTES // 2)))
        part = raw[at : int(ends[low:high].max())]
        a, b = starts[low:high] - at, ends[low:high] - at
        with np.errstate(over="ignore"):
            powers = np.multiply.accumulate(np.full(len(part), _FACTOR, np.uint64))
            back = np.multiply.accumulate(np.full(int(a[-1]) + 1, _INVERSE, np.uint64))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[part] * powers, out=sums[1:])
            found[low:high] = mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
        low = high
    return found


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each ``n`` consecutive values; there are ``len(hashes) - n + 1``."""
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
        for k in range(n):
            total = (total ^ hashes[k : k + len(total)]) * _FACTOR + np.uint64(k)
            total ^= total >> np.uint64(29)
        return mix(total)
