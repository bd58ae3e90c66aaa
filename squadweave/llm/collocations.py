"""Phrase collocation mining by direct-address tiling.

Words get ids by their rank in frequency within their language. Every pair of
neighbours lies in a tile of ``TILE`` x ``TILE`` ids: tiles that many pairs of
a block of text fall into are counted with one dense bincount each, all other
pairs as sorted coordinates. Frequent pairs are ranked anew and meet the next
word in the same way, and so on up to the longest phrase.

A phrase can only be frequent if its beginning and its end are, so all others
are left out before anything is shuffled. Ids exist for a head of at most
``HEAD`` words or phrases a level, which is what tasks hold; a rarer frequent
word goes by its hash, and whether it is frequent is asked of a bit filter of a
fixed size, which may say yes too often: such phrases are dropped by their
count. So every count is exact whatever the head holds. Hashes are 63 bits of
language and word, and are drawn anew if a frequent word shares one.

Counts leave a task as packed arrays of distinct phrases, dealt into buckets by
a hash of the phrase, so that a frequent word, pair or language spreads over
all buckets; the number of buckets grows with the number of words.

A null text is empty, a null language ``und``; ids do not matter, so repeated
rows count each time. Other columns are left out. No documents, no phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from squadweave.llm.common import (
    LOWER,
    broadcast_state,
    byte_table,
    mix,
    text_slices,
    with_state,
    word_hashes,
    word_spans,
    written,
)

TILE = 256
# Tiles from the most frequent ids on, each way, that may be counted densely.
GRID = 64
# A tile is dense in a block where one pair falls on this many of its cells.
CELLS_A_PAIR = 8
# Words or phrases a level that have ids: 8 bytes each for hash, id and order.
HEAD = 1 << 20
# Bits of the filter for those that have none, a power of two.
FILTER_BITS = 1 << 26
# Neighbours counted at once in a task.
BLOCK = 1_500_000
# Distinct words gathered in a task before they are passed on.
GATHERED = 500_000
# Words of text per bucket of phrase counts.
BUCKET_WORDS = 2_000_000
SLICE = 1 << 21
# Shares of a language's phrases that are ranked by themselves first.
SHARES = 8

HASH_BITS = 63
UNKNOWN = "und"

BREAK = byte_table(list(b".,;:!?\n\x0b\x0c\r"))
WORD = ~(BREAK | byte_table(list(b" \t")))
_STEP = np.uint64(0x9FB21C651E98DF25)


def shuffled_bytes(seed: int) -> np.ndarray:
    """A permutation of byte values, by which words hash differently for every seed."""
    return np.random.RandomState(seed).permutation(256).astype(np.uint8)


def language_hashes(languages: list[str], seed: int) -> np.ndarray:
    digests = [hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest() for lang in languages]
    return np.frombuffer(b"".join(digests), np.uint64)


def negative(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of so many bits as negative numbers, which no id is."""
    low = hashes & np.uint64((1 << bits) - 1)
    return (low | np.uint64(1 << 63)).view(np.int64)


def words_of(batch: pa.RecordBatch, seed: int, bits: int):
    """Per slice: lower-case bytes, starts, ends, languages, each word's language, hash, and whether the next word follows in its piece."""
    for low, high, raw, offsets in text_slices(batch["text"], SLICE):
        raw = LOWER[raw]
        starts, ends, first = word_spans(raw, offsets, WORD)
        coded = batch["lang"].slice(low, high - low).fill_null(UNKNOWN).dictionary_encode()
        languages = coded.dictionary.to_pylist()
        language = np.repeat(coded.indices.to_numpy(zero_copy_only=False), np.diff(first))
        found = word_hashes(shuffled_bytes(seed)[raw], starts, ends) ^ language_hashes(languages, seed)[language]
        pieces = np.cumsum(BREAK[raw], dtype=np.int32)[starts]
        follows = np.zeros(len(starts), bool)
        follows[:-1] = pieces[1:] == pieces[:-1]
        edges = first[1:-1]
        follows[edges[edges > 0] - 1] = False
        yield raw, starts, ends, languages, language, negative(mix(found), bits), follows


def runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where each run of equal rows begins in it."""
    order = np.argsort(columns[0]) if len(columns) == 1 else np.lexsort(columns[::-1])
    changes = np.zeros(len(order), bool)
    changes[:1] = True
    for column in columns:
        sorted_column = column[order]
        changes[1:] |= sorted_column[1:] != sorted_column[:-1]
    return order, np.flatnonzero(changes)


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted, with the sum of their counts."""
    if not len(counts):
        return columns, counts
    order, first = runs(columns)
    return [column[order[first]] for column in columns], np.add.reduceat(counts[order], first)


def _slice_words(raw, starts, ends, languages, language, hashes, seed: int) -> pa.Table:
    """Distinct words of a slice with their counts; a language's own row, without a word, counts all its words.

    Words are told apart by a second hash also, so that two with one hash both come out.
    """
    check = word_hashes(shuffled_bytes(seed + (1 << 20))[raw], starts, ends).view(np.int64)
    order, first = runs([hashes, check])
    some = order[first]
    counts = np.diff(np.append(first, len(order)))
    length = ends[some] - starts[some]
    bounds = np.concatenate([[0], np.cumsum(length)])
    flat = np.arange(bounds[-1]) + np.repeat(starts[some] - bounds[:-1], length)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(raw[flat])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(some), buffers).cast(pa.binary()).cast(pa.string())
    names = pa.array(languages, pa.string())
    every = np.bincount(language, minlength=len(languages))
    return pa.table(
        {
            "hash": np.concatenate([hashes[some], negative(mix(language_hashes(languages, seed)), HASH_BITS)]),
            "check": np.concatenate([check[some], np.zeros(len(languages), np.int64)]),
            "lang": pa.chunked_array([names.take(pa.array(language[some])), names]),
            "word": pa.chunked_array([words, pa.nulls(len(languages), pa.string())]),
            "n": np.concatenate([counts, every]),
        }
    )


def count_words(docs: DataFrame, seed: int, bits: int, gathered: int = GATHERED) -> DataFrame:
    """``hash``, ``lang``, ``word``, ``n``, ``texts``: each hash's most frequent word, and how many words share it.

    A language has a row without a word that counts all its words.
    """

    def merged(tables: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(tables).combine_chunks()
        columns = [table[name].to_numpy() for name in ("hash", "check")]
        order, first = runs(columns)
        at = pa.array(order[first])
        counts = np.add.reduceat(table["n"].to_numpy()[order], first)
        return table.drop_columns("n").take(at).append_column("n", pa.array(counts))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for raw, starts, ends, languages, language, hashes, _ in words_of(batch, seed, bits):
                if len(starts):
                    held.append(_slice_words(raw, starts, ends, languages, language, hashes, seed))
                if sum(map(len, held)) > gathered:
                    held = [merged(held)]
                    if len(held[0]) > gathered // 2:
                        yield from held.pop().drop_columns("check").combine_chunks().to_batches(1 << 16)
        if held:
            yield from merged(held).drop_columns("check").combine_chunks().to_batches(1 << 16)

    # Dealt by the hash alone, so that words of one hash meet without another shuffle.
    dealt = docs.mapInArrow(tally, "hash long, lang string, word string, n long").repartition("hash")
    words = dealt.groupBy("hash", "lang", "word").agg(F.sum("n").alias("n"))
    return words.groupBy("hash").agg(
        F.max_by("lang", "n").alias("lang"),
        F.max_by("word", "n").alias("word"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("texts"),
    )


class Level:
    """Frequent words, or frequent phrases of one length: ids of the head, sorted by key, and a filter for the rest.

    Ids count from a multiple of ``TILE`` in every language, by frequency.
    """

    def __init__(self, keys: np.ndarray, words: np.ndarray, language: np.ndarray, n: np.ndarray, filter_bits: np.ndarray):
        """``keys`` look a word or phrase up, ``words`` are its hashes, one column a word."""
        order = np.lexsort((-n, language))
        first = np.flatnonzero(np.append(True, np.diff(language[order]) > 0)) if len(order) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(order)))
        rows = -(-size // TILE)
        self.size = int(rows.sum()) * TILE + 1
        base = (np.cumsum(rows) - rows) * TILE
        ids = np.repeat(base - first, size) + np.arange(len(order))
        # Per row of tiles: its language, and which row of that language it is.
        self.language = np.repeat(language[order][first], rows) if len(order) else language
        self.place = np.arange(int(rows.sum())) - np.repeat(base // TILE, rows)
        self.words = np.zeros((self.size, words.shape[1]), np.int64)
        self.words[ids] = words[order]
        by_key = np.argsort(keys[order])
        self.keys, self.ids = keys[order][by_key], ids[by_key]
        self.filter_bits = filter_bits

    def ids_of(self, keys: np.ndarray) -> np.ndarray:
        """Ids of keys, -1 for one that has none."""
        if not len(self.keys) or not len(keys):
            return np.full(len(keys), -1)
        distinct, at = np.unique(keys, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return np.where(self.keys[place] == distinct, self.ids[place], -1)[at]

    def perhaps(self, codes: np.ndarray) -> np.ndarray:
        """Whether the filter may hold codes."""
        if not len(self.filter_bits):
            return np.zeros(len(codes), bool)
        found = np.ones(len(codes), bool)
        for word, bit in filter_places(codes, len(self.filter_bits) * 64):
            found &= (self.filter_bits[word] & bit) != 0
        return found


def filter_places(codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Machine word and bit of each of a code's two places in a filter of so many bits."""
    spread = mix(codes)
    for place in (spread & np.uint64(bits - 1), (spread >> np.uint64(32)) & np.uint64(bits - 1)):
        yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def extended(codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Codes of phrases that have one word more."""
    return mix(codes * _STEP + words.view(np.uint64))


def code_of(columns: list[np.ndarray]) -> np.ndarray:
    return reduce(extended, columns[1:], columns[0].view(np.uint64))


def filter_of(rest: DataFrame, columns: list[str], bits: int) -> np.ndarray:
    """The filter that holds the rows of ``rest``: pieces are made in tasks, joined by a bitwise or, and at most ``bits`` bits in all."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = code_of([batch[name].to_numpy() for name in columns])
            word, bit = (np.concatenate(x) for x in zip(*filter_places(codes, bits), strict=True))
            order, first = runs([word])
            if len(order):
                joined = np.bitwise_or.reduceat(bit[order], first).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word[order[first]]), pa.array(joined)], ["word", "bits"])

    found = rest.select(columns).mapInArrow(pieces, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = found.toArrow()
    held = np.zeros(bits // 64, np.uint64)
    held[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return held


def head_of(table: DataFrame, head: int) -> tuple[Column, bool]:
    """Which rows of ``table`` have the largest ``n``, at most ``head`` of them, and whether there are others."""
    size = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    steps = sorted(table.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True)
    least, rows = 1 << 30, 0
    for step in steps:
        rows += step["rows"]
        if rows > head:
            break
        least = step["size"]
    return size >= least, rows > head


def level_of(table: DataFrame, columns: list[str], below: list[Level], head: int, filter_bits: int) -> Level:
    """The level of the words or phrases of ``table``; ``below`` are those of shorter ones.

    A phrase is in the head only where its beginning and its last word are.
    """
    inside, more = head_of(table, head)
    found = table.filter(inside).select(*columns, "n", *([] if below else ["lang"])).toArrow()
    words = np.stack([found[name].to_numpy() for name in columns], axis=1).reshape(-1, len(columns))
    n = found["n"].to_numpy()
    if not below:
        _, language = np.unique(found["lang"].to_numpy().astype(str), return_inverse=True)
        keys, known = words[:, 0], np.ones(len(words), bool)
    else:
        start, last = ids_through(below, list(words.T[:-1])), below[0].ids_of(words[:, -1])
        known = (start >= 0) & (last >= 0)
        words, n, start, last = words[known], n[known], start[known], last[known]
        keys, language = start * below[0].size + last, below[0].language[last // TILE]
    rest = table if not known.all() else table.filter(~inside)
    held = filter_of(rest, columns, filter_bits) if more or not known.all() else np.zeros(0, np.uint64)
    return Level(keys, words, language, n, held)


def ids_through(levels: list[Level], columns: list[np.ndarray]) -> np.ndarray:
    """Ids of phrases given by the hashes of their words, -1 for one that has none."""
    ids = levels[0].ids_of(columns[0])
    for level, column in zip(levels[1:], columns[1:], strict=False):
        last = levels[0].ids_of(column)
        both = (ids >= 0) & (last >= 0)
        ids = np.where(both, level.ids_of(np.where(both, ids * levels[0].size + last, -1)), -1)
    return ids


def neighbours(levels: list[Level], hashes: np.ndarray, follows: np.ndarray):
    """Phrases one word longer than those of the last level, where they begin: the id of all but the last word, that word's id, the place.

    Left out are phrases whose beginning or end cannot be frequent.
    """
    words = levels[0]
    first = words.ids_of(hashes)
    codes = hashes.view(np.uint64)
    ids, member = first, (first >= 0) | words.perhaps(codes)
    for size, level in enumerate(levels[1:], 2):
        ids, member, codes = _longer(ids, member, codes, hashes, follows, first, size)
        packed = member & (ids >= 0) & (first[size - 1 :] >= 0)
        key = np.where(packed, ids * words.size + first[size - 1 :], -1)
        ids = np.full(len(key), -1)
        ids[packed] = level.ids_of(key[packed])
        member &= (ids >= 0) | level.perhaps(codes)
    size = len(levels) + 1
    ids, member, codes = _longer(ids, member, codes, hashes, follows, first, size)
    at = np.flatnonzero(member)
    return ids[at], first[at + size - 1], at


def _longer(ids, member, codes, hashes, follows, first, size: int):
    """Cut places down to those where a phrase of ``size`` words can begin, as both its parts are members and lie in one piece."""
    room = max(len(hashes) - size + 1, 0)
    member = member[:room] & member[1 : room + 1] & follows[size - 2 : size - 2 + room]
    return ids[:room], member, extended(codes[:room], hashes[size - 1 : size - 1 + room])


def tiled_counts(left: Level, right: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of ids as numbers ``a * right.size + b``, and how often each occurs."""
    if not len(a):
        return a, b
    row, column = left.place[a // TILE], right.place[b // TILE]
    near = (row < GRID) & (column < GRID)
    tile = np.where(near, (right.language[b // TILE] * GRID + row) * GRID + column, -1)
    order = np.argsort(tile, kind="stable")
    edges = np.flatnonzero(np.diff(tile[order], prepend=-1))
    size = np.diff(np.append(edges, len(order)))
    many = size >= TILE * TILE // CELLS_A_PAIR
    keys, counts = [], []
    dense = np.zeros(len(a), bool)
    for low, pairs in zip(edges[many], size[many], strict=True):
        inside = order[low : low + pairs]
        dense[inside] = True
        cell = np.bincount(a[inside] % TILE * TILE + b[inside] % TILE, minlength=TILE * TILE)
        hit = np.flatnonzero(cell)
        corner_a, corner_b = a[inside[0]] // TILE * TILE, b[inside[0]] // TILE * TILE
        keys.append((corner_a + hit // TILE) * right.size + corner_b + hit % TILE)
        counts.append(cell[hit])
    sparse, n = np.unique(a[~dense] * right.size + b[~dense], return_counts=True)
    return np.concatenate([*keys, sparse]), np.concatenate([*counts, n])


def planes(numbers: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, all lowest ones first: the high ones of small numbers pack well."""
    return numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


PACKED = "bucket long, counts binary, packed binary, wide array<binary>"


def packed_counts(columns: list[np.ndarray], counts: np.ndarray, buckets: int, wide: bool) -> Iterator[dict]:
    """Counted rows dealt into buckets, each bucket's sorted, its first column as differences."""
    bucket = (mix(code_of(columns)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*columns[::-1], bucket))
    edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        at = order[low:high]
        first = planes(np.diff(columns[0][at], prepend=np.int64(0)))
        rest = [planes(column[at]) for column in columns[1:]]
        yield {
            "bucket": int(bucket[at[0]]),
            "counts": planes(counts[at]),
            "packed": None if wide else first,
            "wide": [first, *rest] if wide else None,
        }


def count_phrases(docs: DataFrame, levels: list[Level], seed: int, bits: int, buckets: int, least: int, block: int) -> DataFrame:
    """``w0``, ``w1``, ..., ``n``: phrases one word longer than those of the last level that occur ``least`` times or more.

    Places overlap. Counts of a block of text are added up before they leave the task.
    """
    size = len(levels) + 1
    held = [broadcast_state(docs.sparkSession, level) for level in levels]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [with_state(Level, state) for state in held]
        ids: list[tuple[np.ndarray, np.ndarray]] = []
        wide: list[list[np.ndarray]] = []

        def flush() -> list[dict]:
            rows = []
            if ids:
                a, b = (np.concatenate(x) for x in zip(*ids, strict=True))
                keys, counts = tiled_counts(known[-1], known[0], a, b)
                rows += packed_counts([keys], counts, buckets, False)
            if wide:
                columns = [np.concatenate(x) for x in zip(*wide, strict=True)]
                rows += packed_counts(*summed(columns, np.ones(len(columns[0]), np.int64)), buckets, True)
            ids.clear()
            wide.clear()
            return rows

        n = 0
        for batch in batches:
            for *_, hashes, follows in words_of(batch, seed, bits):
                a, b, at = neighbours(known, hashes, follows)
                both = (a >= 0) & (b >= 0)
                ids.append((a[both], b[both]))
                wide.append([hashes[at[~both] + k] for k in range(size)])
                n += len(at)
                if n > block:
                    yield from in_batches(flush())
                    n = 0
        yield from in_batches(flush())

    kinds = pa.schema([("bucket", pa.int64()), ("counts", pa.binary()), ("packed", pa.binary()), ("wide", pa.list_(pa.binary()))])

    def in_batches(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[low : low + 256], kinds)

    def add_up(table: pa.Table) -> pa.Table:
        words, start = with_state(Level, held[0]), with_state(Level, held[-1])
        found = []
        for wide in (False, True):
            rows = [row for row in table.to_pylist() if (row["wide"] is not None) == wide]
            if rows:
                parts = [[from_planes(x) for x in (row["wide"] if wide else [row["packed"]])] for row in rows]
                columns = [np.concatenate(x) for x in zip(*[[np.cumsum(p[0]), *p[1:]] for p in parts], strict=True)]
                columns, n = summed(columns, np.concatenate([from_planes(row["counts"]) for row in rows]))
                columns, n = [column[n >= least] for column in columns], n[n >= least]
                if not wide:
                    columns = [*start.words[columns[0] // words.size].T, words.words[columns[0] % words.size, 0]]
                found.append([*columns, n])
        return pa.table(dict(zip([*names, "n"], map(np.concatenate, zip(*found, strict=True)), strict=True)))

    names = [f"w{k}" for k in range(size)]
    counted = docs.mapInArrow(tally, PACKED)
    schema = ", ".join(f"{name} long" for name in [*names, "n"])
    return counted.groupBy("bucket").applyInArrow(add_up, schema)


def mine(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    least: int = 10,
    cover_percent: int = 50,
    top: int = 2000,
    head: int = HEAD,
    filter_bits: int = FILTER_BITS,
    block: int = BLOCK,
    bucket_words: int = BUCKET_WORDS,
    hash_bits: int = HASH_BITS,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends,
    and those into words at spaces and tabs. A phrase occurs ``a`` times, at
    least ``least``; of its cuts into two parts, which occur ``l`` and ``r``
    times, the one with the lowest score ``floor(1000000 * a * a / (l * r))``
    counts, then the one with the shortest first part. A phrase goes if a
    longer one that holds its words occurs at least ``cover_percent`` % as often.
    ``n`` counts all words of the language. Ranks go by score, then ``a``, both
    descending, then by the phrase.
    """
    docs = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    for seed in count():
        known = written(count_words(docs, seed, hash_bits).filter((F.col("n") >= least) | F.col("word").isNull()))
        if known.filter("texts > 1").isEmpty():
            break
    vocabulary = known.filter(F.col("word").isNotNull()).withColumnRenamed("hash", "w0")
    totals = known.filter(F.col("word").isNull()).select("lang", F.col("n").alias("n_lang"))
    words = totals.agg(F.sum("n_lang")).first()[0] or 0
    buckets = -(-words // bucket_words) or 1

    tables = [vocabulary]
    levels: list[Level] = []
    for size in range(2, longest + 1):
        columns = [f"w{k}" for k in range(size - 1)]
        levels.append(level_of(tables[-1], columns, levels, head, filter_bits))
        tables.append(written(count_phrases(docs, levels, seed, hash_bits, buckets, least, block)))
    found = reduce(DataFrame.unionByName, [_scored(tables, size, cover_percent) for size in range(2, longest + 1)])
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # First within a share of a language's phrases, so that its last ranking sees ``SHARES * top`` of them at most.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    best = found.withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("n_lang", "n"), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _scored(tables: list[DataFrame], size: int, cover_percent: int) -> DataFrame:
    """Phrases of ``size`` words that no longer one covers, with their lowest-scoring cut."""
    columns = [f"w{k}" for k in range(size)]
    phrases = tables[size - 1].withColumnRenamed("n", "a")
    longer = [
        table.select(*[F.col(f"w{k + shift}").alias(f"w{k}") for k in range(size)], "n")
        for more, table in enumerate(tables[size:], size + 1)
        for shift in range(more - size + 1)
    ]
    if longer:
        most = reduce(DataFrame.unionByName, longer).groupBy(*columns).agg(F.max("n").alias("most"))
        phrases = phrases.join(most, columns, "left").filter(
            F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * cover_percent)
        ).drop("most")
    for cut in range(1, size):
        left, right = columns[:cut], columns[cut:]
        start = tables[cut - 1].select(*[F.col(f"w{k}").alias(name) for k, name in enumerate(left)], F.col("n").alias(f"l{cut}"))
        end = tables[size - cut - 1].select(*[F.col(f"w{k}").alias(name) for k, name in enumerate(right)], F.col("n").alias(f"r{cut}"))
        phrases = phrases.join(start, left).join(end, right)
    # l and r are at least a, so a score is at most a million; 38 digits hold a million times a number of 28.
    score = lambda cut: F.expr(
        f"cast(1000000 as decimal(7,0)) * (cast(a as decimal(14,0)) * cast(a as decimal(14,0)))"
        f" div (cast(l{cut} as decimal(14,0)) * cast(r{cut} as decimal(14,0)))"
    )
    cuts = [
        F.struct(score(cut).alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r"))
        for cut in range(1, size)
    ]
    phrases = phrases.withColumn("best", F.array_min(F.array(*cuts)))
    for k, name in enumerate(columns):
        spelled = tables[0].select(F.col("w0").alias(name), F.col("word").alias(f"word{k}"), *([F.col("lang")] if k == 0 else []))
        phrases = phrases.join(spelled, name)
    phrase = F.concat_ws(" ", *[F.col(f"word{k}") for k in range(size)])
    return phrases.select("lang", phrase.alias("phrase"), "a", "best.l", "best.r", "best.score")
