"""Quality and toxicity by co-training two views of a document.

One classifier sees the text's words, the other the page's metadata: its columns
and the figures of its form. In each round
both score a pool of unlabelled documents, and each hands its most confident
verdicts to the other as labels. Afterwards each view is calibrated on labelled
documents that neither was trained on, a last small model weighs the two, and
every document is scored by it.

The classifiers are logistic models over hashed features, fitted on a bounded
sample of documents of any length, of which features alone reach the driver;
scoring reads every text whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from squadweave.llm.collocations import from_planes, planes
from squadweave.llm.common import (
    LOWER,
    broadcast_state,
    byte_table,
    mix,
    text_slices,
    with_state,
    word_hashes,
    word_spans,
)

# Labelled documents to train on, to calibrate on, and unlabelled ones in the pool: about so many of each at most, picked
# by a hash of the id.
TRAINED, CALIBRATED, POOL = 5000, 2500, 2500
BUCKETS = 1 << 18
ROUNDS = 3
# Features that fewer training documents have are left out of a fit.
LEAST_SEEN = 2
# The share of the pool that a view hands on in a round, of either verdict, and how sure it must be of them.
HANDED, SURE = 0.05, 0.9

_WORD = byte_table([*range(0x61, 0x7B), *range(0x80, 0x100)])
_BLANKS = [32, 9, 10, 11, 12, 13]
_UPPER, _DIGIT = byte_table(range(65, 91)), byte_table(range(48, 58))
_MARK = byte_table([b for b in range(33, 128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)])
_SPLIT = ~byte_table(_BLANKS)
SHAPES = 8
# Bytes of the word beginnings that are features beside whole words.
STEMS = (3, 4, 5, 6)


# The figures of a text's form stand behind the hashed values of the metadata, in ten steps each.
METADATA_SIZE = BUCKETS + SHAPES * 11


@dataclass
class Rows:
    """Sparse rows: values of the features ``index`` between ``starts``."""

    index: np.ndarray
    value: np.ndarray
    starts: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.index] * self.value)])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def back(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, np.repeat(errors, np.diff(self.starts)) * self.value, size)

    def take(self, rows: np.ndarray) -> Rows:
        lengths = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(starts[-1]) - np.repeat(starts[:-1], lengths) + np.repeat(self.starts[:-1][rows], lengths)
        return Rows(self.index[at], self.value[at], starts)

    def plus(self, other: Rows) -> Rows:
        return Rows(
            np.concatenate([self.index, other.index]),
            np.concatenate([self.value, other.value]),
            np.concatenate([self.starts, other.starts[1:] + self.starts[-1]]),
        )


def empty_rows() -> Rows:
    return Rows(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64))


def shapes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Figures of each text's form, all between 0 and 1: repeats, capitals, digits, marks, word lengths, lines."""
    starts, ends, first = word_spans(raw, offsets, _SPLIT)
    n = np.maximum(np.diff(first), 1)
    size = np.maximum(np.diff(offsets), 1)
    hashes = word_hashes(raw, starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])

    def per_row(flags, bounds):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    twice = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1)
    distinct = np.bincount(twice[0].astype(np.int64), minlength=len(n))[: len(n)]
    figures = [
        per_row(same, first) / n,
        1 - distinct / n,
        per_row(_UPPER[raw], offsets) / size,
        per_row(_DIGIT[raw], offsets) / size,
        np.minimum(1, per_row(_MARK[raw], offsets) / size * 4),
        np.minimum(1, per_row(ends - starts, first) / n / 20),
        np.minimum(1, per_row(raw == 10, offsets) / n * 5),
        np.minimum(1, np.log1p(np.diff(first)) / 12),
    ]
    return np.stack(figures, axis=1)


def content_rows(column: pa.Array) -> Rows:
    """The content of all texts of a column."""
    parts = [empty_rows(), *(rows for _, _, rows, _ in content_slices(column))]
    lengths = np.concatenate([np.diff(rows.starts) for rows in parts])
    return Rows(
        np.concatenate([rows.index for rows in parts]),
        np.concatenate([rows.value for rows in parts]),
        np.concatenate([[0], np.cumsum(lengths)]),
    )


def content_slices(column: pa.Array) -> Iterator[tuple[int, int, Rows, np.ndarray]]:
    """Each text's words and word beginnings, hashed, by how often they occur, and the features of its form.

    A run of rows at a time, as (first row, last row + 1, features, those of the form).
    """
    for low_row, high_row, index, counts, starts, form in counted_slices(column):
        yield low_row, high_row, Rows(index, weight_of(counts), starts), form


def weight_of(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts).astype(np.float32)


def counted_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``content_slices`` with the features' counts."""
    for low_row, high_row, raw, offsets in text_slices(column):
        n = len(offsets) - 1
        form = BUCKETS + np.arange(SHAPES) * 11 + np.minimum(10, shapes(raw, offsets) * 10).astype(np.int64)
        low = LOWER[raw]
        begin, end, first = word_spans(low, offsets, _WORD)
        row = np.repeat(np.arange(n), np.diff(first))
        keys = []
        for size in (*STEMS, 0):
            long = end - begin > size
            spans = word_hashes(low, begin[long], begin[long] + size if size else end[long])
            bucket = (mix(spans + np.uint64(size)) % np.uint64(BUCKETS)).astype(np.int64)
            keys.append(row[long] * BUCKETS + bucket)
        keys, counts = np.unique(np.concatenate(keys), return_counts=True)
        starts = np.concatenate([[0], np.cumsum(np.bincount(keys // BUCKETS, minlength=n))])
        yield low_row, high_row, (keys % BUCKETS).astype(np.int32), counts, starts, form


def with_form(rows: Rows, form: np.ndarray) -> Rows:
    """Rows of equally many values each, and the features of the form behind them."""
    n = len(form)
    index = np.hstack([rows.index.reshape(n, len(rows.index) // max(1, n)), form])
    return Rows(index.ravel(), np.ones(index.size), np.arange(n + 1) * index.shape[1])


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` with features in place of ``_text``: ``_index`` and ``_counts`` of its content, ``_form``, packed."""
    others = [c for c in rows.columns if c != "_text"]

    def run(batches):
        for batch in batches:
            for low, high, index, counts, starts, form in counted_slices(batch.column(len(others))):
                each = list(zip(starts.tolist(), starts[1:].tolist()))
                packed = [
                    [zlib.compress(planes(np.diff(index[a:b].astype(np.int64), prepend=np.int64(0))), 1) for a, b in each],
                    [zlib.compress(planes(counts[a:b]), 1) for a, b in each],
                    [row.tobytes() for row in form],
                ]
                kept = [column.slice(low, high - low) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.binary()) for x in packed)], [*others, "_index", "_counts", "_form"])

    kinds = [rows.schema[c] for c in others] + [StructField(c, BinaryType()) for c in ("_index", "_counts", "_form")]
    return rows.select(*others, "_text").mapInArrow(run, StructType(kinds))


def unpacked(found: pa.Table) -> tuple[Rows, np.ndarray]:
    """The content and the form of the rows of ``featured``."""
    index = [np.cumsum(from_planes(zlib.decompress(x.as_py()))).astype(np.int32) for x in found.column("_index")]
    value = [weight_of(from_planes(zlib.decompress(x.as_py()))) for x in found.column("_counts")]
    form = [np.frombuffer(x.as_py(), np.int64) for x in found.column("_form")]
    starts = np.cumsum([0, *map(len, index)])
    none = empty_rows()
    rows = Rows(np.concatenate([none.index, *index]), np.concatenate([none.value, *value]), starts)
    return rows, np.stack(form) if form else np.zeros((0, SHAPES), np.int64)


def metadata_rows(columns: list[pa.Array], n_rows: int) -> Rows:
    """Every metadata value, hashed with its column's number; numbers by their order of magnitude; null is a value."""
    index = np.zeros((n_rows, len(columns)), np.int64)
    for k, column in enumerate(columns):
        values = column.to_pylist()
        words = [f"{k}:{int(np.log1p(abs(x)) * 4) if isinstance(x, (int, float)) and x == x else x}".encode() for x in values]
        raw = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum([0, *map(len, words)])
        index[:, k] = (mix(word_hashes(raw, at[:-1], at[1:])) % np.uint64(BUCKETS)).astype(np.int64)
    return Rows(index.ravel(), np.ones(index.size), np.arange(n_rows + 1) * len(columns))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def leaning(rows: Rows, labels: np.ndarray, size: int, added: float = 0.5) -> np.ndarray:
    """Each feature's log odds between the classes, shrunk where it is rare, 0 where it is rarer than ``LEAST_SEEN``."""
    of = np.repeat(labels.astype(np.float32), np.diff(rows.starts))
    seen = np.bincount(rows.index, minlength=size)
    ups = np.bincount(rows.index, of, size)
    odds = np.log((ups + added) / (labels.sum() + 2 * added)) - np.log((seen - ups + added) / ((1 - labels).sum() + 2 * added))
    return np.where(seen < LEAST_SEEN, 0.0, odds * np.minimum(1, seen / 5))


def fit(rows: Rows, labels: np.ndarray, size: int, penalty: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights of a logistic model, the last one its constant, by Adam on all rows; both classes weigh the same.

    Features are scaled by their own leaning first, so that the many words that tell nothing stay small.
    """
    scale = leaning(rows, labels, size)
    used = np.flatnonzero(scale)
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used))
    told = place[rows.index] >= 0
    sums = np.concatenate([[0], np.cumsum(told)])
    index = place[rows.index[told]]
    scaled = Rows(index, rows.value[told] * scale[used][index], sums[rows.starts])
    weights, mean, square = (np.zeros(len(used) + 1) for _ in range(3))
    share = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    for step in range(1, steps + 1):
        errors = (sigmoid(scaled.dot(weights) + weights[-1]) - labels) * share
        slope = scaled.back(errors, len(weights))
        slope[-1] = errors.sum()
        slope[:-1] += penalty * weights[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        weights -= 0.08 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(size + 1)
    full[used] = weights[:-1] * scale[used]
    full[-1] = weights[-1]
    return full


def logits(rows: Rows, weights: np.ndarray) -> np.ndarray:
    return rows.dot(weights) + weights[-1]


def calibrate(x: np.ndarray, labels: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic weights over a few columns and a constant, by Newton's method with a little shrinkage."""
    full = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(full.shape[1])
    for _ in range(min(steps, 50)):
        p = sigmoid(full @ weights)
        slope = full.T @ (p - labels) + 0.01 * weights
        curve = (full * (p * (1 - p))[:, None]).T @ full + 0.01 * np.eye(len(weights))
        move = np.linalg.solve(curve, slope)
        weights -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return weights


@dataclass
class CoTrained:
    """Per target: the two views' weights, their calibrations, and the weights of the two in the combined score."""

    targets: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def scores(self, target: str, content: Rows, metadata: Rows) -> np.ndarray:
        content_w, metadata_w, content_c, metadata_c, combined = self.targets[target]
        views = [
            logits(content, content_w) * content_c[0] + content_c[1],
            logits(metadata, metadata_w) * metadata_c[0] + metadata_c[1],
        ]
        return sigmoid(np.column_stack([*views, np.ones(len(views[0]))]) @ combined)


def hand_over(found: np.ndarray, share: float, sure: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that a view is surest of, of either verdict, and those verdicts."""
    p, most = sigmoid(found), max(1, int(share * len(found)))
    order = np.argsort(found, kind="stable")
    low, high = order[:most], order[::-1][:most]
    low, high = low[p[low] <= 1 - sure], high[p[high] >= sure]
    return np.concatenate([low, high]), np.concatenate([np.zeros(len(low)), np.ones(len(high))])


def co_train(labels, trained: tuple[Rows, Rows], pool: tuple[Rows, Rows], held: tuple[Rows, Rows], held_labels, rounds=ROUNDS):
    """Both views' weights and the calibrations of one target."""
    sizes, own = (BUCKETS, METADATA_SIZE), [(rows, labels) for rows in trained]
    n_pool = len(pool[0].starts) - 1
    weights = [fit(rows, y, size) for (rows, y), size in zip(own, sizes)]
    for _ in range(rounds if n_pool else 0):
        taught = set()
        for teacher, pupil in ((0, 1), (1, 0)):
            # A view without any power to tell held-out documents apart teaches nothing.
            if ranking(logits(held[teacher], weights[teacher]), held_labels) < 0.75:
                continue
            rows, y = hand_over(logits(pool[teacher], weights[teacher]), HANDED, SURE)
            own[pupil] = (trained[pupil].plus(pool[pupil].take(rows)), np.concatenate([labels, y]))
            taught.add(pupil)
        weights = [fit(*own[view], sizes[view]) if view in taught else weights[view] for view in (0, 1)]
    found = [logits(rows, w) for rows, w in zip(held, weights)]
    calibrations = [calibrate(x[:, None], held_labels) for x in found]
    views = np.column_stack([x * c[0] + c[1] for x, c in zip(found, calibrations)])
    return (*weights, *calibrations, calibrate(views, held_labels))


def ranking(scores: np.ndarray, labels: np.ndarray) -> float:
    """The chance that a positive row scores above a negative one; 0.5 where there are no such pairs."""
    ups = int(labels.sum())
    if not 0 < ups < len(labels):
        return 0.5
    values, place, many = np.unique(scores, return_inverse=True, return_counts=True)
    ranks = (np.cumsum(many) - (many - 1) / 2)[place]
    return float((ranks[labels > 0].sum() - ups * (ups + 1) / 2) / (ups * (len(labels) - ups)))


def _sample(rows: DataFrame, most: int, salt: str) -> DataFrame:
    """About ``most`` rows at most, picked by a hash of the id."""
    n, steps = rows.count(), 1 << 30
    limit = steps if n <= most else most * steps // n
    return rows.filter(F.pmod(F.xxhash64(F.lit(salt), F.col("_id").cast("string")), F.lit(steps)) < limit)


def one_each(rows: DataFrame) -> DataFrame:
    """One row of each ``_id``, the one with the smallest hash, so that a repeated id counts once."""
    rest = [c for c in rows.columns if c != "_id"]
    one = F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("_one")
    return rows.groupBy("_id").agg(one).select("_id", *[F.col("_one")[c].alias(c) for c in rest])


def train(
    docs: DataFrame,
    labels: DataFrame,
    targets: tuple[str, ...] = ("quality", "toxic"),
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata: tuple[str, ...] = ("source", "lang", "n_chars"),
    trained: int = TRAINED,
    calibrated: int = CALIBRATED,
    pooled: int = POOL,
) -> CoTrained:
    """Co-train both views on bounded samples: of labelled documents for training and calibration, and of others as pool.

    Labels that are null, or whose document is missing or has no text, teach
    nothing; of several labels of one document, any one counts, and of several rows of one id, one. A target without
    both verdicts in its samples is scored by their share alone.
    """
    known = labels.select(F.col(id_col).alias("_id"), *targets).filter("_id is not null").dropDuplicates(["_id"])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *metadata)
    texts = texts.filter(F.octet_length("_text") > 0)
    picked = _sample(known, trained + calibrated, "labelled").select("_id", *[F.col(t).alias(f"_{t}") for t in targets])
    some = featured(one_each(texts.join(F.broadcast(picked), "_id"))).toArrow()
    rest = _sample(texts.select("_id"), pooled * 2, "pool").join(known.select("_id"), "_id", "left_anti")
    rest = featured(one_each(texts.join(F.broadcast(rest.distinct()), "_id", "left_semi"))).toArrow()

    def views(found: pa.Table) -> tuple[Rows, Rows]:
        found = found.combine_chunks()
        parts = [found.column(c).combine_chunks() if found.num_rows else pa.array([], found.schema.field(c).type) for c in metadata]
        content, form = unpacked(found)
        return content, with_form(metadata_rows(parts, found.num_rows), form)

    pool = views(rest)
    del rest
    names = np.array([str(x) for x in some.column("_id").to_pylist()])
    order = np.argsort(names, kind="stable")
    some = some.take(pa.array(order))
    both = views(some)
    held = np.array([hash_of(x) % (trained + calibrated) < calibrated for x in names[order]], bool)
    models = {}
    for target in targets:
        y = np.array([np.nan if x is None else float(x > 0) for x in some.column(f"_{target}").to_pylist()])
        usable = ~np.isnan(y)
        here, there = np.flatnonzero(usable & ~held), np.flatnonzero(usable & held)
        if min(len(set(y[here])), len(set(y[there]))) < 2:
            share = float(y[usable].mean()) if usable.any() else 0.5
            constant = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
            none = np.zeros(2)
            models[target] = (np.zeros(BUCKETS + 1), np.zeros(METADATA_SIZE + 1), none, none, np.array([0, 0, constant]))
            continue
        models[target] = co_train(
            y[here], tuple(x.take(here) for x in both), pool, tuple(x.take(there) for x in both), y[there]
        )
    return CoTrained(models)


def hash_of(name: str) -> int:
    raw = np.frombuffer(name.encode() or b"\0", np.uint8)
    return int(word_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


def score(
    docs: DataFrame,
    model: CoTrained,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata: tuple[str, ...] = ("source", "lang", "n_chars"),
) -> DataFrame:
    """One row per document: its id and, for each target, its probability under the combined views.

    Null texts are empty, null metadata is a value of its own; repeated rows
    and null ids are scored like any other; no other column is read.
    """
    shared = broadcast_state(docs.sparkSession, model)
    targets = list(model.targets)

    def run(batches):
        model = with_state(CoTrained, shared)
        for batch in batches:
            found = {target: np.zeros(batch.num_rows) for target in targets}
            for low, high, content, form in content_slices(batch.column(1)):
                columns = [batch.column(k).slice(low, high - low) for k in range(2, batch.num_columns)]
                extra = with_form(metadata_rows(columns, high - low), form)
                for target in targets:
                    found[target][low:high] = model.scores(target, content, extra)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.values())], [id_col, *targets])

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *[F.col(c).alias(f"_{c}") for c in metadata]
    )
    return wanted.mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *[f"{t} double" for t in targets]]))
