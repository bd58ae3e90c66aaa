"""Near-duplicates by b-bit MinHash signatures and a multi-index Hamming join.

A signature has 128 positions of 16 bits. The join runs on the first 64, cut into
16 chunks of four. If two signatures differ in at most 31 positions, some chunk
differs in at most one (pigeonhole: two errors in each of 16 chunks would be
32), so both hold the same three of its four positions: 64 keys a signature
enumerate every chunk and every place of its allowed error, and no pair under
the threshold is missed. Sets that overlap by three quarters or more differ in
each position with a chance of at most 1/4, hence exceed 31 of 64, or 56 of all
128, in fewer than 2 of 100,000 cases. All pairs left are confirmed on the full sets.

Groups stay cheap without caps: equal sets are one class from the start; each
key links its classes to one of them first, chosen anew by every key; and only
classes of one key that are not connected by then are compared with each other,
in blocks of bounded size that emit no pair but those within the threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import (
    LOWER,
    NOT_BLANK,
    mix,
    sequence_hashes,
    text_slices,
    word_hashes,
    word_spans,
    written,
)

SHINGLE = 5
POSITIONS, JOINED, CHUNK = 128, 64, 4
MAX_JOINED, MAX_ALL = 31, 56
# Classes of one key that a task compares with each other at once.
BLOCK = 2048

_RANDOM = np.random.RandomState(11)
_FACTORS = (_RANDOM.randint(0, 1 << 62, POSITIONS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _RANDOM.randint(0, 1 << 62, POSITIONS).astype(np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> list[np.ndarray]:
    """Each row's distinct shingles as sorted 64-bit hashes; a row of fewer words is one shingle, a row of none has none."""
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets, NOT_BLANK)
    hashes = word_hashes(raw, starts, ends)
    runs = sequence_hashes(hashes, n)
    found = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= n:
            found.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            found.append(mix(sequence_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def signature(shingles: np.ndarray) -> bytes:
    """The 16-bit minima of a set under each of ``POSITIONS`` hash functions."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(least, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=least)
    return (mix(least) >> np.uint64(48)).astype("<u2").tobytes()


def fingerprint(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set: equal sets have equal ones."""
    with np.errstate(over="ignore"):
        total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(mix(np.array([total + np.uint64(len(shingles)) * np.uint64(0x2545F4914F6CDD1D)]))[0].astype(np.int64))


def sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``id``, ``n`` (set size), ``node`` (its set's fingerprint), ``sig``; without words the last two are null."""

    def run(batches):
        for batch in batches:
            n, node, sig = [], [], []
            for _, _, raw, offsets in text_slices(batch.column(1)):
                for shingles in shingle_sets(raw, offsets):
                    n.append(len(shingles))
                    node.append(fingerprint(shingles) if len(shingles) else None)
                    sig.append(signature(shingles) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())],
                ["id", "n", "node", "sig"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n bigint, node bigint, sig binary"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, POSITIONS)


def chunk_keys(classes: DataFrame) -> DataFrame:
    """``key``, ``node``: every chunk of every signature with each of its positions left out; the key's last 6 bits say which."""

    def run(batches):
        for batch in batches:
            sig = _matrix(batch.column(1)).astype(np.uint64)
            nodes = batch.column(0).to_numpy()
            chunks = sig[:, :JOINED].reshape(len(sig), JOINED // CHUNK, CHUNK)
            for low in range(0, JOINED // CHUNK, 4):
                keys = []
                for chunk in range(low, low + 4):
                    for out in range(CHUNK):
                        a, b, c = (chunks[:, chunk, k] for k in range(CHUNK) if k != out)
                        value = mix(a | b << np.uint64(16) | c << np.uint64(32))
                        keys.append(value - value % np.uint64(JOINED) + np.uint64(chunk * CHUNK + out))
                key = np.concatenate(keys).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.tile(nodes, len(keys)))], ["key", "node"])

    return classes.select("node", "sig").mapInArrow(run, "key bigint, node bigint")


def ordered(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signatures are within the threshold, on the joined positions and on all."""
    differ = a != b
    return (differ[..., :JOINED].sum(-1) <= MAX_JOINED) & (differ.sum(-1) <= MAX_ALL)


def within(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs whose signatures and set sizes allow a link, and ``differ``, how many positions are unequal."""

    def side(name):
        return classes.select(
            F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"sig_{name}")
        )

    def run(batches):
        for batch in batches:
            a, b = _matrix(batch.column(2)), _matrix(batch.column(3))
            rows = np.flatnonzero(near(a, b))
            differ = (a[rows] != b[rows]).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(differ.astype(np.int32))], ["a", "b", "differ"]
            )

    possible = 4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(possible)
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint, differ int")


def of_own_set(texts: DataFrame) -> DataFrame:
    """The rows (``node``, ``text``) whose text has the set of that node: an id may stand for several texts."""

    def run(batches):
        for batch in batches:
            nodes = [
                fingerprint(x) for _, _, raw, offsets in text_slices(batch.column(1)) for x in shingle_sets(raw, offsets)
            ]
            yield batch.filter(pa.array(np.array(nodes, np.int64) == batch.column(0).to_numpy()))

    return texts.mapInArrow(run, texts.schema)


def texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``node``, ``text``: a text of each class of ``classes`` (``node``, ``doc``), from ``docs`` (``doc``, ``text``).

    A text repeated under one id comes once. Classes without an id look for
    their texts among the rows without one.
    """
    alike = docs.join(classes, "doc").groupBy("doc", "node", F.xxhash64("text")).agg(F.first("text").alias("text"))

    def nodes(batches):
        for batch in batches:
            found = [
                fingerprint(x) if len(x) else None
                for _, _, raw, offsets in text_slices(batch.column(0))
                for x in shingle_sets(raw, offsets)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), batch.column(0)], ["node", "text"])

    unnamed = docs.filter(F.col("doc").isNull()).select("text").mapInArrow(nodes, "node bigint, text string")
    wanted = classes.filter(F.col("doc").isNull()).select("node")
    unnamed = unnamed.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    return of_own_set(alike.select("node", "text")).unionByName(unnamed)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets overlap by three quarters of their union."""

    def run(batches):
        def all_sets(column):
            return [x for _, _, raw, offsets in text_slices(column) for x in shingle_sets(raw, offsets)]

        for batch in batches:
            keep = []
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                for a, b in zip(all_sets(part.column(2)), all_sets(part.column(3))):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= 75 * (len(a) + len(b) - both))
            rows = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    sides = [texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node reachable over ``edges`` (``a``, ``b``), for every node of an edge.

    Every node moves to its smallest neighbour, edges move along, and this
    repeats on the contracted edges until none is left.
    """
    labels = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        step = written(both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("label")))
        labels = step if labels is None else relabelled(labels, step)
        edges = written(contracted(edges, step).distinct())
        if edges.isEmpty():
            return written(labels)


def relabelled(labels: DataFrame, step: DataFrame) -> DataFrame:
    """``labels`` after their labels moved by ``step``."""
    onward = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))


def contracted(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs between different labels, as pairs of labels; a node without a label is its own."""
    for x in "ab":
        side = labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}"))
        pairs = pairs.join(side, x, "left").withColumn(f"label_{x}", F.coalesce(f"label_{x}", x))
    return ordered(pairs.filter("label_a <> label_b"), F.col("label_a"), F.col("label_b"))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` once the components that ``edges`` link are one."""
    step = components(contracted(edges, labels).distinct())
    fresh = step.join(labels, "node", "left_anti")
    return written(relabelled(labels, step).union(fresh))


def apart(rows: DataFrame, classes: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of one key's classes that lie in different components and whose sets overlap enough, by 32-bit hashes.

    Each pair is compared once, under the first key that it shares, in a block of at most two times ``BLOCK`` classes.
    """
    marked = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    # Written first, so that the join meets plain shuffles and a key of very many classes is split.
    mixed = written(
        marked.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("many"))
        .filter("low <> high")
        .select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"))
    )

    def small(batches):
        for batch in batches:
            found = [
                np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes()
                for _, _, raw, offsets in text_slices(batch.column(1))
                for x in shingle_sets(raw, offsets)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "small"])

    # A block meets every block once: as the lower one of a pair, or as the higher.
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        marked.join(mixed, "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "node", "label", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .join(classes.select("node", "n", "sig"), "node")
        .join(texts.select("node", "text").mapInArrow(small, "node bigint, small binary"), "node")
    )

    def compare(group):
        sig = _matrix(group.column("sig"))
        node, label, n, side = (group.column(x).to_numpy() for x in ("node", "label", "n", "block"))
        i, j, slot = group.column("i")[0].as_py(), group.column("j")[0].as_py(), group.column("key")[0].as_py() % JOINED
        sets = [np.frombuffer(x, np.uint32) for x in group.column("small").to_pylist()]
        pairs = []
        for at in range(len(node)):
            other = np.flatnonzero(
                (label != label[at])
                & (node > node[at])
                & (4 * np.minimum(n, n[at]) >= 3 * np.maximum(n, n[at]))
                & ((i == j) | (side != side[at]))
            )
            other = other[near(sig[other], sig[at])]
            other = other[first_key(sig[other], sig[at]) == slot]
            for to in other.tolist():
                both = len(np.intersect1d(sets[at], sets[to], assume_unique=True))
                # Two of a set's hashes may coincide: hence one percent less.
                if 100 * both >= 74 * (len(sets[at]) + len(sets[to]) - both):
                    pairs.append((node[at], node[to]))
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def first_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first of the 64 ways to leave out a position in which signatures share a key."""
    differ = (a != b)[..., :JOINED].reshape(-1, JOINED // CHUNK, CHUNK)
    errors = differ.sum(-1)
    chunk = np.argmax(errors <= 1, axis=1)
    return chunk * CHUNK + np.argmax(differ[np.arange(len(differ)), chunk], axis=1)


def unconnected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs that are not in one component yet."""
    same = [labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab"]
    both = pairs.join(same[0], "a", "left").join(same[1], "b", "left")
    return both.filter(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether
    that is the document's own. Documents without words have an empty set and
    are components of their own. Every row is judged by its own text, so repeated
    rows share a component. Null ids are left out of the minimum: a row without
    an id has the smallest id reachable, and only where there is none a null
    component, and is kept. Other columns are not read.
    """
    rows = written(sets(docs, id_col, text_col))
    classes = written(
        rows.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    )
    keys = chunk_keys(classes)
    # A key's order of classes is its own; the hub is the first. A pair of classes needs no more than the two ends.
    turn = F.xxhash64("key")
    shared = written(
        keys.withColumn("place", F.col("node").bitwiseXOR(turn))
        .groupBy("key")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.count("*").alias("many"))
        .filter("low <> high")
        .select("key", F.col("low").bitwiseXOR(turn).alias("hub"), F.col("high").bitwiseXOR(turn).alias("end"), "many")
    )
    crowded = written(keys.join(shared.filter("many > 2").select("key", "hub"), "key"))
    star = ordered(shared.filter("many = 2"), F.col("hub"), F.col("end")).union(
        ordered(crowded.filter("node <> hub"), F.col("hub"), F.col("node"))
    )
    candidates = written(within(star.distinct(), classes))

    nodes = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).union(crowded.select("node")).distinct()
    mine = classes.join(nodes, "node", "left_semi").select("node", F.col("id").alias("doc"))
    texts = written(texts_of(docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")), mine))
    # The likeliest link of each class first, then whatever of the others is still needed, then pairs that share only
    # keys whose hub links neither.
    best = F.min_by(F.struct("a", "b"), F.struct("differ", "a", "b"))
    likely = [candidates.groupBy(x).agg(best.alias("p")).select("p.*") for x in "ab"]
    labels = components(written(confirmed(likely[0].union(likely[1]).distinct(), texts)))
    labels = merged(labels, written(confirmed(unconnected(candidates, labels), texts)))
    across = written(apart(crowded.select("key", "node"), classes, texts, labels))
    labels = merged(labels, written(confirmed(across, texts)))
    named = (
        classes.join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .select("node", "id", "label")
    )
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    by_node = named.select("node", "label").join(smallest, "label").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.join(by_node, "node", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
