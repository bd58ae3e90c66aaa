"""Language-model scoring with a probabilistic suffix tree over words.

Contexts are runs of up to ``depth`` words. A context is retained if words follow it
``LEAST_COUNT`` times at least and their distribution diverges from that of its
suffix. Under a retained context, such words have counts of their own, smoothed
by an absolute discount; the mass so freed goes to the suffix's distribution,
down to the smoothed distribution of single words. A word is scored in the
longest retained suffix of what stands before it.

The least count is absolute, so the tree grows with the corpus. A run of words
is counted only where both runs one word shorter reach the least count, which a
bit filter of fixed size tells; where it fills, more is counted, but nothing is lost.

What a retained context or an entry adds to a score is one number of its own
(the weight of the suffix, or what the entry's probability has over the
suffix's), so the tree is a table of 64-bit codes and numbers, of which a place
in a text adds up at most two for each length. The head is broadcast: a fixed
number of the most frequent words, contexts and entries. A bit filter leaves out what the tree does not hold, and the runs that
remain meet the table bucket by bucket: they leave tasks as packed arrays, a run
once for both its numbers, and come back as sums of a block of documents. Words
and runs are told apart by 64-bit hashes there.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.llm.collocations import PACKED, filter_of, filter_places, from_planes, head_of, packed_counts, planes, runs, summed
from squadweave.llm.common import (
    LOWER,
    NOT_BLANK,
    broadcast_state,
    forget,
    sequence_hashes,
    text_slices,
    with_state,
    word_hashes,
    word_spans,
    written,
)

# Least count of a word after a context for an entry of its own.
LEAST_COUNT = 4
# Words of the longest contexts.
DEPTH = 2
# The most frequent words, and contexts and entries, that every task knows, at most.
HEAD_WORDS = 1 << 18
HEAD_CODES = 1 << 20
# Least relative frequency of such words, and of contexts and entries after one word and after more.
WORD_SHARE = 0.0
CONTEXT_SHARE = 0.0
DEEP_SHARE = 0.0
# Bits of each filter, a power of two.
FILTER_BITS = 1 << 26
# Words of text per bucket of counted runs.
BUCKET_WORDS = 1_000_000
# Words of training text per bucket of the tree as scoring looks runs up, and how many meet one before it is shared out.
LOOKUP_WORDS = 2_000_000
LOOKUP_PLACES = 2_000_000
# Places of a bucket that go in one row, that leave a task in one batch (or counts of runs), and that are looked up at
# once: an executor holds batches and rows in a task, so they are bounded whatever the number of buckets.
ROW_PLACES = 1 << 15
BATCH_PLACES = 1 << 18
LOOKED_UP = 1 << 18
# Bytes of text that a task takes apart at once.
SLICE_BYTES = 1 << 20
# Least Kullback-Leibler divergence, in nats a word, of a context's distribution from its suffix's.
DIVERGENCE = 0.02
DISCOUNT = 0.5
ADDED = 0.1
# Entries a task gathers before it hands them on.
GATHERED_WORDS = 250_000
GATHERED_RUNS = 1_000_000
GATHERED_PLACES = 1_000_000


def in_training(id_col: Column, folds: int = 10) -> Column:
    """Training documents: all whose crc32 modulo ``folds`` is not 0; a null id is one."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds != 0, F.lit(True))


def rows_of_words(column: pa.Array):
    """For each slice of rows, the lower-case words of each, an empty one for the end of the text."""
    for _, _, raw, offsets in text_slices(column, SLICE_BYTES):
        raw = LOWER[raw].tobytes()
        yield [[*raw[a:b].split(), b""] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


# Stands for the end of a text where words are hashes.
END = np.uint64(1)


def hashed_rows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of rows one after the other, each row's end included, and where each row starts."""
    return spanned_rows(LOWER[raw], offsets)[:2]


def spanned_rows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``hashed_rows`` of lower-case bytes, and where each word begins and ends; a row's end is an empty word."""
    starts, ends, first = word_spans(raw, offsets, NOT_BLANK)
    hashes = np.insert(word_hashes(raw, starts, ends), first[1:], END)
    return hashes, first + np.arange(len(first)), np.insert(starts, first[1:], 0), np.insert(ends, first[1:], 0)


class Finder:
    """Finds hashes among sorted ``known`` ones: by their first bits, then one by one."""

    def __init__(self, known: np.ndarray):
        bits = max(1, len(known).bit_length())
        self.size = len(known)
        self.shift = np.uint64(64 - bits)
        self.known = np.append(known, np.uint64(2**64 - 1))
        self.first = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each code stands or would stand, and whether it is there."""
        at = self.first[(codes >> self.shift).view(np.int64)]
        there = self.known[at]
        left = np.flatnonzero(there < codes)
        while len(left):
            at[left] += 1
            there[left] = self.known[at[left]]
            left = left[there[left] < codes[left]]
        return at, (there == codes) & (at < self.size)


def numbers_of(known: Finder, number: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers of word hashes, -1 for one that is not ``known``."""
    slot, hit = known.find(words)
    found = np.full(len(words), -1)
    found[hit] = number[slot[hit]]
    return found


def with_hashes(counts: DataFrame) -> DataFrame:
    """``word``, ``n``, ``hash``, the word's, and ``code``, the word's as a run of its own."""

    def run(batches):
        for batch in batches:
            parts = []
            for _, _, raw, offsets in text_slices(batch.column(0)):
                found = word_hashes(raw, offsets[:-1], offsets[1:])
                found[np.diff(offsets) == 0] = END
                parts.append(found.view(np.int64))
            hashes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            codes = run_codes(hashes.view(np.uint64), 1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes), pa.array(codes)], ["word", "n", "hash", "code"])

    return counts.mapInArrow(run, "word string, n bigint, hash bigint, code bigint")


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n`` over the one text column; the empty word counts the ends of texts."""

    def packed(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for rows in rows_of_words(batch.column(0)):
                for words in rows:
                    counts.update(words)
                if len(counts) >= GATHERED_WORDS:
                    yield packed(counts)
                    counts.clear()
        yield packed(counts)

    return texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Tables:
    """The whole tree, as scoring joins it."""

    words: DataFrame  # word, n, hash, code of what the head does not hold
    deltas: DataFrame  # code, delta of what the head does not hold


def perhaps(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold codes."""
    found = np.ones(len(codes), bool)
    for k, (word, bit) in enumerate(filter_places(codes, len(bits) * 64)):
        # Most codes are ruled out by the first bit.
        left = np.flatnonzero(found) if k else slice(None)
        found[left] = (bits[word[left]] & bit[left]) != 0
    return found


def kind_of(size: int, context: bool) -> int:
    return 2 * size + context


def run_codes(hashes: np.ndarray, size: int, context: bool = False) -> np.ndarray:
    """A 64-bit code of each ``size`` consecutive words, as a context or as a context and the word behind it."""
    codes = sequence_hashes(hashes, size)
    return ~codes if context else codes


@dataclass
class Tree:
    """The suffix tree's head: words by number in falling order of count, -1 is any other word; sorted codes with what
    they add to a score and their kinds; and the filter of all codes of the tree."""

    total: int
    distinct: int
    depth: int = DEPTH
    words: list[bytes] = field(default_factory=list)
    single: np.ndarray = field(default_factory=lambda: np.zeros(1))
    # By word number, and one that no word has at the end.
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    deltas: np.ndarray = field(default_factory=lambda: np.zeros(0))
    kinds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    bits: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint64))

    @property
    def retained1(self) -> np.ndarray:
        """Which of the codes are contexts of one word."""
        return self.kinds == kind_of(1, True)

    @property
    def context2(self) -> np.ndarray:
        """Codes of contexts of two words."""
        return self.codes[self.kinds == kind_of(2, True)]

    @property
    def codes1(self) -> np.ndarray:
        """Codes of the entries of contexts of one word."""
        return self.codes[self.kinds == kind_of(2, False)]

    @property
    def logs1(self) -> np.ndarray:
        """What the entries of ``codes1`` add."""
        return self.deltas[self.kinds == kind_of(2, False)]

    def numbers(self, rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of rows one after the other, and where each row starts."""
        starts = np.cumsum([0, *map(len, rows)])
        get = {word: k for k, word in enumerate(self.words)}.get
        return np.fromiter((get(word, -1) for words in rows for word in words), np.int64, starts[-1]), starts

    def logs(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each word by itself and by the head; a word without a number adds only its contexts' weights."""
        return self.settled(ids, starts, self.hashes[ids])[:2]

    @cached_property
    def finder(self) -> Finder:
        return Finder(self.codes)

    def held(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the head adds for codes, and which of them it does not hold."""
        slot, hit = self.finder.find(codes)
        added = np.zeros(len(codes))
        added[hit] = self.deltas[slot[hit]]
        return added, ~hit

    @cached_property
    def lone(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By word number: whether the tree may hold the word as a context, what the head adds for it, whether it may stand beyond the head."""
        codes = ~run_codes(self.hashes, 1)
        may = perhaps(self.bits, codes)
        added, beyond = self.held(codes)
        return may, added, may & beyond

    def settled(self, ids: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """``logs`` of words with these hashes and, for each length, where runs begin that the tree may hold beyond its head, and their codes.

        A run counts once, whether as a context, as an entry or as both: what stands before a word
        also ends with a word.
        """
        alone = self.single[ids]
        best = alone.copy()
        since = np.arange(len(ids)) - np.repeat(starts[:-1], np.diff(starts))
        beyond = [np.zeros(len(ids), bool) for _ in range(self.depth + 1)]
        codes = [run_codes(hashes, size) for size in range(1, self.depth + 2)]
        after = np.flatnonzero(since > 0)
        for k in range(1, self.depth + 1):
            # A context stands before the word. An entry, which ends with the word, needs the context, and that its suffix.
            after = after[since[after] >= k]
            contexts = ~codes[k - 1][after - k]
            if k == 1:
                may, added, rest = (x[ids[after - 1]] for x in self.lone)
                unknown = np.flatnonzero(ids[after - 1] < 0)
                may[unknown] = perhaps(self.bits, contexts[unknown])
                added[unknown], rest[unknown] = self.held(contexts[unknown])
                after, added, rest = after[may], added[may], rest[may]
            else:
                may = perhaps(self.bits, contexts)
                after = after[may]
                added, rest = self.held(contexts[may])
            best[after] += added
            beyond[k - 1][after[rest] - k] = True
            entries = codes[k][after - k]
            ends = np.flatnonzero(perhaps(self.bits, entries))
            added, rest = self.held(entries[ends])
            best[after[ends]] += added
            beyond[k][after[ends[rest]] - k] = True
        at = [np.flatnonzero(x) for x in beyond]
        return alone, best, [(x, code[x]) for x, code in zip(at, codes)]


def distinct_rows(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows in order, their counts, and where each stands first."""
    order, first = runs(list(columns))
    return [x[order[first]] for x in columns], np.diff(np.append(first, len(order))), order[first]


def batches_of(rows, places):
    """Lists of rows that hold about ``BATCH_PLACES`` together."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += places(row)
        if held >= BATCH_PLACES:
            yield part
            part, held = [], 0
    if part:
        yield part


def run_counts(texts: DataFrame, size: int, hashes: np.ndarray, shorter: np.ndarray, least: int, buckets: int) -> DataFrame:
    """All runs of ``size`` words that occur ``least`` times or more: their words' hashes ``x0``, ``x1``, ..., ``n``,
    and the codes of the run, of its ``context`` (without the last word) and of its ``suffix`` (without the first).

    ``shorter`` is the filter of runs one word shorter that do so; the last word may be a text's end. Counts leave a
    task as packed arrays, in which the words with these ``hashes``, as far as numbers of 63 bits in all tell them
    apart, go by number. Two runs of other words are told apart by all their hashes.
    """
    names = [f"x{k}" for k in range(size)]
    width = 63 // size
    order = np.argsort(hashes[: 1 << min(width, 30)])
    state = texts.sparkSession.sparkContext.broadcast((hashes[order], order, shorter))
    kinds = pa.schema([("bucket", pa.int64()), ("counts", pa.binary()), ("packed", pa.binary()), ("wide", pa.list_(pa.binary()))])

    def flush(packed, wide):
        keys = np.concatenate(packed)
        columns = [np.concatenate(x) for x in zip(*wide)]
        packed.clear()
        wide.clear()
        if len(keys):
            keys, n = np.unique(keys, return_counts=True)
            yield from in_batches(packed_counts([keys], n, buckets, False))
        del keys
        if len(columns[0]):
            columns, n = summed(columns, np.ones(len(columns[0]), np.int64))
            yield from in_batches(packed_counts(columns, n, buckets, True))

    def in_batches(rows):
        for part in batches_of(rows, lambda row: len(row["counts"]) // 8):
            yield pa.RecordBatch.from_pylist(part, kinds)

    def run(batches):
        known, number, bits = state.value
        known = Finder(known)
        packed, wide, held = [], [], 0
        for batch in batches:
            for _, _, raw, offsets in text_slices(batch.column(0), SLICE_BYTES):
                words, starts = hashed_rows(raw, offsets)
                often = perhaps(bits, run_codes(words, size - 1))
                whole = often[:-1] & often[1:]
                for k in range(1, size):
                    cut = starts[1:-1] - k
                    whole[cut[(cut >= 0) & (cut < len(whole))]] = False
                at = np.flatnonzero(whole)
                ids = numbers_of(known, number, words)
                parts = [ids[at + k] for k in range(size)]
                common = np.logical_and.reduce([x >= 0 for x in parts])
                packed.append(reduce(lambda code, x: (code << width) | x, [x[common] for x in parts]))
                wide.append([words[at[~common] + k].view(np.int64) for k in range(size)])
                held += len(at)
                if held >= GATHERED_RUNS:
                    yield from flush(packed, wide)
                    held = 0
        if packed:
            yield from flush(packed, wide)

    def add_up(table: pa.Table) -> pa.Table:
        known, number, _ = state.value
        by_number = np.zeros(len(known), np.uint64)
        by_number[number] = known
        found = []
        for wide in (False, True):
            rows = [row for row in table.to_pylist() if (row["wide"] is not None) == wide]
            if rows:
                parts = [[from_planes(x) for x in (row["wide"] if wide else [row["packed"]])] for row in rows]
                columns = [np.concatenate(x) for x in zip(*[[np.cumsum(p[0]), *p[1:]] for p in parts])]
                columns, n = summed(columns, np.concatenate([from_planes(row["counts"]) for row in rows]))
                columns, n = [x[n >= least] for x in columns], n[n >= least]
                if not wide:
                    low = (1 << width) - 1
                    columns = [by_number[(columns[0] >> (width * k)) & low].view(np.int64) for k in reversed(range(size))]
                found.append([*columns, n])
        columns = [np.concatenate(x) for x in zip(*found)]
        hashes = np.stack(columns[:-1], axis=1).ravel().view(np.uint64)
        codes = [run_codes(hashes, size), run_codes(hashes, size - 1), run_codes(hashes, size - 1)[1:]]
        return pa.table(dict(zip(kept, [*columns, *(x[::size].view(np.int64) for x in codes)])))

    kept = [*names, "n", "code", "context", "suffix"]
    schema = ", ".join(f"{x} bigint" for x in kept)
    return texts.mapInArrow(run, PACKED).groupBy("bucket").applyInArrow(add_up, schema)


def smoothed(entries: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Of ``entries`` with ``n``, ``context``, ``context_n``, ``context_suffix`` and ``suffix_p``: the contexts with ``n``,
    their suffix, ``delta`` (the log weight of the suffix) and whether they diverge, and the entries with ``p`` and ``delta``."""
    share = F.col("n") / F.col("context_n")
    own = (F.col("n") - DISCOUNT) / F.col("context_n")
    rest = F.greatest(1 - F.sum(share), F.lit(0.0))
    rest_p = F.greatest(1 - F.sum("suffix_p"), F.lit(1e-12))
    gain = F.sum(share * F.ln(share / F.col("suffix_p"))) + F.when(rest > 0, rest * F.ln(rest / rest_p)).otherwise(0)
    contexts = written(
        entries.groupBy("context").agg(
            F.first("context_n").alias("n"),
            F.first("context_suffix").alias("context_suffix"),
            F.greatest(1 - F.sum(own), F.lit(1e-12)).alias("suffix_share"),
            (gain >= threshold).alias("diverges"),
        )
    )
    both = entries.join(contexts.select("context", "suffix_share"), "context")
    p = own + F.col("suffix_share") * F.col("suffix_p")
    both = both.withColumn("p", p)
    delta = F.log10("p") - F.log10("suffix_p") - F.log10("suffix_share")
    return contexts.withColumn("delta", F.log10("suffix_share")), both.withColumn("delta", delta)


def train(
    texts: DataFrame,
    word_share: float = WORD_SHARE,
    context_share: float = CONTEXT_SHARE,
    deep_share: float = DEEP_SHARE,
    divergence: float = DIVERGENCE,
    least_count: int = LEAST_COUNT,
    depth: int = DEPTH,
    filter_bits: int = FILTER_BITS,
) -> tuple[Tree, Tables]:
    """The tree of a table with one text column: its head, and the tables of all of it."""
    counts = written(with_hashes(word_counts(texts)))
    total, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count("n")).first())
    often = head_of(counts, HEAD_WORDS)[0] & (F.col("n") >= word_share * total)
    frequent = counts.filter(often).toPandas()
    frequent = frequent.sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    n = frequent["n"].to_numpy(np.int64)
    tree = Tree(total, distinct, depth)
    tree.words = [word.encode() for word in frequent["word"]]
    tree.single = np.append(np.log10((n + ADDED) / (total + ADDED * (distinct + 1))), 0.0)
    tree.hashes = np.append(frequent["hash"].to_numpy(np.int64).view(np.uint64), np.uint64(0))
    del frequent

    # Level by level: runs one word longer, whose contexts and suffixes are the runs of the level before.
    p = (F.col("n") + ADDED) / (total + ADDED * (distinct + 1))
    before = counts.select("code", F.lit(None).cast("bigint").alias("suffix"), "n", p.alias("p"))
    buckets = -(-max(1, total) // BUCKET_WORDS)
    levels, dead = [], []
    for size in range(2, depth + 2):
        enough = before.filter(F.col("n") >= least_count)
        shorter = filter_of(enough, ["code"], filter_bits)
        counted = run_counts(texts, size, tree.hashes[:-1], shorter, least_count, buckets).select("code", "context", "suffix", "n")
        suffixes = enough.select(F.col("code").alias("suffix"), F.col("p").alias("suffix_p"))
        contexts = enough.select(
            F.col("code").alias("context"), F.col("n").alias("context_n"), F.col("suffix").alias("context_suffix")
        )
        joined = written(counted.join(suffixes, "suffix").join(contexts, "context"))
        contexts, entries = smoothed(joined, divergence)
        before = written(entries.select("code", "context", "suffix", "n", "p", "delta"))
        levels.append((size, contexts, before))
        dead += [joined, contexts, before]

    parts, needed = [], None
    for size, contexts, entries in reversed(levels):
        # A retained context's suffix is retained, as its entries refer to it.
        if needed is not None:
            contexts = contexts.join(needed, "context", "left").filter(F.col("diverges") | F.col("needed"))
        else:
            contexts = contexts.filter("diverges")
        contexts = written(contexts.select("context", "context_suffix", "n", "delta"))
        dead.append(contexts)
        needed = contexts.select(F.col("context_suffix").alias("context")).distinct().withColumn("needed", F.lit(True))
        own = entries.join(contexts.select("context"), "context", "left_semi")
        # As contexts, runs have the inverse of their code.
        parts.append(contexts.select(F.bitwise_not("context").alias("code"), "n", "delta", F.lit(kind_of(size - 1, True)).alias("kind")))
        parts.append(own.select("code", "n", "delta", F.lit(kind_of(size, False)).alias("kind")))
    deltas = written(reduce(DataFrame.union, parts))
    forget(*dead)

    share = F.when(F.col("kind") <= kind_of(2, False), context_share).otherwise(deep_share)
    common = head_of(deltas, HEAD_CODES)[0] & (F.col("n") >= share * total)
    head = deltas.filter(common).select("code", "delta", "kind").toArrow()
    codes = head["code"].to_numpy().view(np.uint64)
    order = np.argsort(codes)
    tree.codes, tree.deltas, tree.kinds = codes[order], head["delta"].to_numpy()[order], head["kind"].to_numpy()[order].astype(np.int8)
    rest = deltas.filter(~common).select("code", "delta")
    tree.bits = filter_of(rest, ["code"], filter_bits)
    for word, bit in filter_places(tree.codes, filter_bits):
        np.bitwise_or.at(tree.bits, word, bit)
    return tree, Tables(counts.filter(~often), rest)


# Rows that leave a task for a bucket: words, or runs whose words all have numbers (``size`` of them) or are told by their code (0).
SENT = "bucket bigint, part bigint, places bigint, size int, keys binary, lengths binary, rows binary, times binary"
# Sums of a block of documents.
SUMS = "part bigint, size int, rows binary, lift binary, known binary"
WORDS = -1


def bucket_of_code(codes: np.ndarray, buckets: int) -> np.ndarray:
    """A run's bucket, as a context and as an entry."""
    codes = codes.view(np.int64)
    return np.maximum(codes, ~codes) % buckets


def edges_of(bucket: np.ndarray, most: int | None = None) -> list[tuple[int, int]]:
    """Where runs of equal values begin and end; one of more than ``most`` values is several."""
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
    return [(a, min(a + (most or high), high)) for low, high in zip(edges[:-1], edges[1:]) for a in range(low, high, most or high)]


def narrow(numbers: np.ndarray) -> bytes:
    """``planes`` up to the highest byte that any of the numbers has, behind their number."""
    used = int(np.bitwise_or.reduce(numbers.astype(np.int64).view(np.uint64), initial=np.uint64(0))).bit_length()
    width = max(1, -(-used // 8))
    return bytes([width]) + planes(numbers)[: width * len(numbers)]


def from_narrow(data: bytes) -> np.ndarray:
    """The numbers of ``narrow``."""
    found = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    numbers = np.zeros((found.shape[1], 8), np.uint8)
    numbers[:, : data[0]] = found.T
    return numbers.view(np.int64).ravel()


def by_bucket(bucket: np.ndarray, buckets: int, keys: np.ndarray) -> np.ndarray:
    """An order by bucket, then key."""
    by = np.argsort(keys)
    # Few buckets are sorted by their digits.
    return by[np.argsort(bucket[by].astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")]


def sent_runs(ids: np.ndarray, size: int, at: np.ndarray, codes: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Of runs that begin at places, by how they are told apart, size or 0: their keys, and which of them they are."""
    width = 63 // size
    words = [ids[at + k] for k in range(size)]
    common = np.logical_and.reduce([(x >= 0) & (x < 1 << width) for x in words])
    keys = reduce(lambda code, x: (code << width) | x, [x[common] for x in words])
    return [(size, keys, np.flatnonzero(common)), (0, codes[~common].view(np.int64), np.flatnonzero(~common))]


def codes_sent(keys: np.ndarray, size: int, hashes: np.ndarray) -> np.ndarray:
    """Codes of the runs that ``sent_runs`` gave these keys; words have ``hashes`` by number."""
    if not size:
        return keys.view(np.uint64)
    width = 63 // size
    words = [hashes[(keys >> (width * k)) & ((1 << width) - 1)] for k in reversed(range(size))]
    return run_codes(np.stack(words, axis=1).ravel(), size)[::size] if len(keys) else np.zeros(0, np.uint64)


def summed_rows(part: np.ndarray, row: np.ndarray, lift: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums by part and row, in order."""
    order, first = runs([part, row])
    if len(first):
        lift, known = (np.add.reduceat(x[order], first) for x in (lift, known))
    return part[order[first]], row[order[first]], lift, known


def summed_parts(size: int, found: list[tuple[np.ndarray, ...]]) -> pa.Table:
    """What ``summed_rows`` found, summed again, one packed row a part."""
    nothing = np.zeros(0, np.int64)
    part, row, lift, known = summed_rows(*(np.concatenate(x) for x in zip(*found, (nothing, nothing, np.zeros(0), nothing))))
    rows = [
        {
            "part": int(part[low]),
            "size": size,
            "rows": narrow(np.diff(row[low:high], prepend=np.int64(0))),
            "lift": planes(lift[low:high].view(np.int64)),
            "known": narrow(known[low:high]),
        }
        for low, high in edges_of(part)
    ]
    kinds = [("part", pa.int64()), ("size", pa.int32()), ("rows", pa.binary()), ("lift", pa.binary()), ("known", pa.binary())]
    return pa.Table.from_pylist(rows, pa.schema(kinds))


def sent_chunks(sent: pa.Table):
    """Rows of one size that hold about ``LOOKED_UP`` places together, and the part of each place."""
    size, places, part = (sent[x].to_numpy() for x in ("size", "places", "part"))
    for one in np.unique(size):
        at = np.flatnonzero(size == one)
        for low, high in edges_of((np.cumsum(places[at]) - 1) // LOOKED_UP):
            some = at[low:high]
            yield sent.take(some).to_pylist(), np.repeat(part[some], places[some])


def look_up_runs(sent: pa.Table, deltas: pa.Table, hashes: np.ndarray) -> pa.Table:
    """What the runs of a bucket add to the scores of the rows they came from."""
    table = deltas["code"].to_numpy().view(np.uint64)
    order = np.argsort(table)
    finder, delta = Finder(table[order]), np.append(deltas["delta"].to_numpy()[order], 0.0)
    found = []
    for some, part in sent_chunks(sent):
        codes = codes_sent(np.concatenate([np.cumsum(from_narrow(x["keys"])) for x in some]), some[0]["size"], hashes)
        row = np.concatenate([from_narrow(x["rows"]) for x in some])
        lift, any_hit = np.zeros(len(codes)), np.zeros(len(codes), bool)
        for code in (codes, ~codes):
            slot, hit = finder.find(code)
            lift[hit] += delta[slot[hit]]
            any_hit |= hit
        row = row[any_hit]
        found.append(summed_rows(part[any_hit], row, lift[any_hit], np.zeros(len(row), np.int64)))
    return summed_parts(0, found)


def look_up_words(sent: pa.Table, counts: pa.Table) -> pa.Table:
    """What the words of a bucket add to what unknown words score, and how many are known."""
    table = counts["word"].cast(pa.large_binary()).combine_chunks()
    n = counts["n"].to_numpy()
    found = []
    for some, part in sent_chunks(sent):
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(from_narrow(x["lengths"]) for x in some)]))
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(b"".join(x["keys"] for x in some))]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers)
        slot = pc.index_in(words, value_set=table).fill_null(-1).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(slot >= 0)
        row, times = (np.concatenate([from_narrow(x[name]) for x in some])[hit] for name in ("rows", "times"))
        found.append(summed_rows(part[hit], row, times * np.log10((n[slot[hit]] + ADDED) / ADDED), times))
    return summed_parts(WORDS, found)


def sums_of_part(sums: pa.Table) -> pa.Table:
    """``_row``, ``_log``, ``_known``, ``_lift`` of a block's documents."""
    some = sums.to_pylist()
    row = np.concatenate([np.cumsum(from_narrow(x["rows"])) for x in some])
    lift = np.concatenate([from_planes(x["lift"]) for x in some]).view(np.float64)
    word = np.repeat([x["size"] == WORDS for x in some], [len(x["lift"]) // 8 for x in some])
    known = np.concatenate([from_narrow(x["known"]) for x in some])
    row, place = np.unique(row, return_inverse=True)
    log, known, lift = (np.bincount(place, x, len(row)) for x in (np.where(word, lift, 0.0), known, np.where(word, 0.0, lift)))
    return pa.table({"_row": row + some[0]["part"], "_log": log, "_known": known.astype(np.int64), "_lift": lift})


def score(docs: DataFrame, tree: Tree, tables: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    Scores are log10 probabilities of the whole text and its end, by single
    words and by the tree. A null text is empty: its end is its only token.
    Repeated rows and null ids are scored like any other row; other columns are
    not read. Words below the head's share meet their counts, and runs that
    the tree may hold beyond its head the tree's table, in buckets. A bucket that more text
    meets than the tree was made from is dealt out again by blocks of documents.
    """
    # Tasks tell words apart by their hashes.
    shared = broadcast_state(docs.sparkSession, replace(tree, words=[]))
    order = np.argsort(tree.hashes[:-1])
    order = docs.sparkSession.sparkContext.broadcast((order, tree.hashes[order]))
    kind = docs.schema[id_col].dataType.simpleString()
    buckets = -(-max(1, tree.total) // LOOKUP_WORDS)
    unknown = np.log10(ADDED / (tree.total + ADDED * (tree.distinct + 1)))
    scores = f"_row bigint, _id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    sent = [(x.split()[0], {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]]) for x in SENT.split(", ")]

    def run(batches):
        tree = with_state(Tree, shared)
        number, known = order.value[0], Finder(order.value[1])
        columns = None
        base, held = 0, 0
        found_runs: dict[int, list] = {}
        found_words: list[tuple] = []

        def packed_rows():
            while found_runs:
                size, parts = found_runs.popitem()
                keys, bucket, row = (np.concatenate(x) for x in zip(*parts))
                del parts
                by = by_bucket(bucket, buckets, keys)
                keys, bucket, row = keys[by], bucket[by], row[by]
                for low, high in edges_of(bucket, ROW_PLACES):
                    key = narrow(np.diff(keys[low:high], prepend=np.int64(0)))
                    yield int(bucket[low]), base, high - low, size, key, None, narrow(row[low:high]), None
            if found_words:
                words = [word for x in found_words for word in x[0]]
                bucket, row, times = (np.concatenate(x) for x in list(zip(*found_words))[1:])
                found_words.clear()
                by = np.argsort(bucket, kind="stable")
                bucket, row, times = bucket[by], row[by], times[by]
                words = [words[k] for k in by.tolist()]
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                for low, high in edges_of(bucket, ROW_PLACES):
                    packed = (b"".join(words[low:high]), *(narrow(x[low:high]) for x in (lengths, row, times)))
                    yield int(bucket[low]), base, high - low, WORDS, *packed

        def in_batch(rows):
            part = list(zip(*rows))
            arrays = [pa.array(x, t) for x, (_, t) in zip(part, sent)]
            return pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), t) for _, t in columns), *arrays], [x for x, _ in columns + sent])

        def flush():
            for rows in batches_of(packed_rows(), lambda row: row[2]):
                yield in_batch(rows)

        for batch in batches:
            if columns is None:
                kinds = [batch.column(0).type, batch.column(1).type, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                columns = list(zip(["_row", "_id", "n_tokens", "n_known", "base_score", "score"], kinds))
            for low, high, raw, offsets in text_slices(batch.column(2), SLICE_BYTES):
                raw = LOWER[raw]
                numbers = batch.column(0).slice(low, high - low).to_numpy()
                if not held:
                    base = int(numbers[0])
                hashes, starts, begin, end = spanned_rows(raw, offsets)
                ids = numbers_of(known, number, hashes)
                alone, deep, beyond = tree.settled(ids, starts, hashes)
                inside = np.repeat(numbers - base, np.diff(starts))
                for size, (places, codes) in enumerate(beyond, 1):
                    if len(places):
                        bucket, row = bucket_of_code(codes, buckets), inside[places]
                        for told, keys, some in sent_runs(ids, size, places, codes):
                            if len(keys):
                                found_runs.setdefault(told, []).append((keys, bucket[some], row[some]))
                        held += len(places)
                at = np.flatnonzero(ids < 0)
                if len(at):
                    (rare_row, rare), times, first = distinct_rows(inside[at], hashes[at])
                    data = raw.tobytes()
                    words = [data[a:b] for a, b in zip(begin[at[first]].tolist(), end[at[first]].tolist())]
                    found_words.append((words, rare.view(np.int64) % buckets, rare_row, times))
                    held += len(words)
                sums = [np.add.reduceat(x, starts[:-1]) for x in (ids >= 0, alone, deep)]
                # Words without a number score as unknown ones here, and more where they are found.
                tokens, n_known = np.diff(starts), sums[0].astype(np.int64)
                missing = (tokens - n_known) * unknown
                arrays = [tokens, n_known, sums[1] + missing, sums[2] + missing]
                arrays = [*(batch.column(k).slice(low, high - low) for k in (0, 1)), *map(pa.array, arrays)]
                arrays += [pa.nulls(high - low, t) for _, t in sent]
                yield pa.RecordBatch.from_arrays(arrays, [x for x, _ in columns + sent])
                if held >= GATHERED_PLACES:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()

    numbered = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.col(text_col).cast("string").alias(text_col)
    )
    scored = written(numbered.mapInArrow(run, f"{scores}, {SENT}"))
    hashes = docs.sparkSession.sparkContext.broadcast(tree.hashes)

    def of_runs(left: pa.Table, right: pa.Table) -> pa.Table:
        return look_up_runs(left, right, hashes.value)

    def met(kind: Column, table: DataFrame, key: Column, look_up) -> DataFrame:
        # Blocks deal out a bucket that many of them meet; the table's rows go to every share.
        mine = scored.filter(kind)
        most = mine.groupBy("bucket").agg(F.sum("places").alias("n")).agg(F.max("n")).first()[0] or 0
        shares = max(1, -(-most // LOOKUP_PLACES))
        left = mine.withColumn("share", F.pmod(F.xxhash64("part"), F.lit(shares)))
        right = table.withColumn("bucket", F.pmod(key, F.lit(buckets))).withColumn(
            "share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint")))
        )
        left = left.select("bucket", "share", *[x for x, _ in sent[1:]]).groupBy("bucket", "share")
        return left.cogroup(right.groupBy("bucket", "share")).applyInArrow(look_up, SUMS)

    code = F.greatest(F.col("code"), F.bitwise_not("code"))
    runs_met = met(F.col("size") >= 0, tables.deltas.select("code", "delta"), code, of_runs)
    words_met = met(F.col("size") == WORDS, tables.words.select("word", "n", "hash"), F.col("hash"), look_up_words)
    sums = runs_met.union(words_met).groupBy("part").applyInArrow(sums_of_part, "_row bigint, _log double, _known bigint, _lift double")
    log = F.coalesce("_log", F.lit(0.0))
    return scored.filter(F.col("size").isNull()).drop(*[x for x, _ in sent]).join(sums, "_row", "left").select(
        F.col("_id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + log).alias("base_score"),
        (F.col("score") + log + F.coalesce("_lift", F.lit(0.0))).alias("score"),
    )
