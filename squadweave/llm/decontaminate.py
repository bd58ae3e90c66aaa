"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document streams its
words through it and tracks the longest match that ends at each word. Where
that match has ``window`` words, its last ``window`` words stand in an item; an
item shorter than a window is one window itself. Words covered by any such
occurrence are hit.

Only stretches whose neighbouring words also are neighbours in some item are
streamed: a match cannot cross any other place, so nothing is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import (
    LOWER,
    broadcast_state,
    byte_table,
    fresh,
    text_slices,
    with_state,
    word_hashes,
    word_spans,
    written,
)

WINDOW = 10
# Items are dealt into automata of about this many bytes of text, so that what is broadcast at once is bounded
# (some 100 MB at most); each automaton passes over all documents.
SHARD_BYTES = 1 << 20
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z is lower case.
WORD = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

HITS = "array<int>"


class Automaton:
    """A generalised suffix automaton over word hashes, with the items of each window; items are named by anything hashable."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int):
        self.window = window
        words = [hashes for _, hashes in items]
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        self.size = max(1, len(self.vocabulary))
        self.next: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        self.out: list[dict[int, int]] = [{}]
        coded = [(name, np.searchsorted(self.vocabulary, hashes).tolist()) for name, hashes in items if len(hashes)]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self.extend(last, code)
        for state, edges in enumerate(self.out):
            for code, to in edges.items():
                self.next[state * self.size + code] = to
        del self.out
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, codes in coded:
            state, matched = 0, 0
            for code in codes:
                state, matched = self.step(state, matched, code)
                if matched >= window:
                    self.full.setdefault(self.cut(state, window), set()).add(name)
            if len(codes) < window:
                self.short.setdefault(self.cut(state, len(codes)), []).append((len(codes), name))
        self.least = min([window, *(len(codes) for _, codes in coded)])
        pairs = [np.array(codes[:-1], np.int64) * self.size + codes[1:] for _, codes in coded if len(codes) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)

    def extend(self, last: int, code: int) -> int:
        """Append a word to the item being added; ``last`` is the state of the item so far."""
        out, length, link = self.out, self.length, self.link
        to = out[last].get(code)
        if to is not None:
            return to if length[to] == length[last] + 1 else self.split(last, code, to)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        out.append({})
        at = last
        while at >= 0 and code not in out[at]:
            out[at][code] = new
            at = link[at]
        if at >= 0:
            to = out[at][code]
            link[new] = to if length[to] == length[at] + 1 else self.split(at, code, to)
        return new

    def split(self, at: int, code: int, to: int) -> int:
        """Give the shorter strings of state ``to`` a state of their own."""
        out, length, link = self.out, self.length, self.link
        clone = len(length)
        length.append(length[at] + 1)
        link.append(link[to])
        out.append(dict(out[to]))
        link[to] = clone
        while at >= 0 and out[at].get(code) == to:
            out[at][code] = clone
            at = link[at]
        return clone

    def step(self, state: int, matched: int, code: int) -> tuple[int, int]:
        """The longest match after one more word."""
        to = self.next.get(state * self.size + code)
        while to is None and state:
            state = self.link[state]
            matched = self.length[state]
            to = self.next.get(state * self.size + code)
        return (0, 0) if to is None else (to, matched + 1)

    def cut(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match of at least ``n`` words."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def hits(self, codes: list[int], base: int, ranges: list[list[int]], names: set[str]) -> None:
        """Stream words; add the word ranges hit, in order of their ends, and the items that occur."""
        state, matched, window, short = 0, 0, self.window, self.short
        for at, code in enumerate(codes, base):
            state, matched = self.step(state, matched, code)
            longest = 0
            if matched >= window:
                longest = window
                names |= self.full[self.cut(state, window)]
            if short:
                up, limit = state, matched
                while up > 0:
                    for n, name in short.get(up, ()):
                        if n <= limit:
                            longest = max(longest, n)
                            names.add(name)
                    up = self.link[up]
            if longest:
                ranges.append([at + 1 - longest, at + 1])

    def scan(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list[list[int]], set[str]]]]:
        """Words per row, and for rows with hits their ranges and items."""
        raw = LOWER[raw]
        starts, ends, first = word_spans(raw, offsets, WORD)
        found: dict[int, tuple[list[list[int]], set[str]]] = {}
        if not len(starts) or not len(self.vocabulary):
            return np.diff(first), found
        hashes = word_hashes(raw, starts, ends)
        codes = np.minimum(np.searchsorted(self.vocabulary, hashes), self.size - 1)
        known = self.vocabulary[codes] == hashes
        row = np.searchsorted(first, np.arange(len(starts)), "right") - 1
        near = known[:-1] & known[1:] & (row[:-1] == row[1:])
        at = np.flatnonzero(near)
        pair = codes[at].astype(np.int64) * self.size + codes[at + 1]
        slot = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        near[at] = (self.pairs[slot] == pair) if len(self.pairs) else False
        begins, stops = known.copy(), known.copy()
        begins[1:] &= ~near
        stops[:-1] &= ~near
        lows, highs = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        long = highs - lows >= self.least
        for low, high in zip(lows[long].tolist(), highs[long].tolist()):
            of = int(row[low])
            ranges, names = found.setdefault(of, ([], set()))
            self.hits(codes[low:high].tolist(), low - int(first[of]), ranges, names)
        return np.diff(first), {of: x for of, x in found.items() if x[0]}


def merged(ranges: list[list[int]]) -> list[list[int]]:
    done: list[list[int]] = []
    for a, b in sorted(ranges):
        if done and a <= done[-1][1]:
            done[-1][1] = max(done[-1][1], b)
        else:
            done.append([a, b])
    return done


def item_words(text: str | None) -> np.ndarray:
    raw = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), WORD)
    return word_hashes(raw, starts, ends)


def automata(items: DataFrame, item_col: str, text_col: str, window: int, shard_bytes: int):
    """One automaton after the other and the names of its texts, each over one shard, so that the driver holds one at a time.

    Equal texts are one, with all their names; null is not among these.
    """
    named = items.select(F.col(item_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    texts = named.groupBy("text").agg(F.collect_set("name").alias("names"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    for k in range(shards):
        mine = texts.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == k) if shards > 1 else texts
        rows = mine.collect()
        yield Automaton([(k, item_words(r.text)) for k, r in enumerate(rows)], window), [r.names for r in rows]


def marked(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` and four columns after its own: words, words hit, their ranges (first, last + 1, ...), names of items found.

    One pass over the documents per automaton, without a shuffle; each pass
    adds to what the ones before it found. Null texts and items have no words;
    an item without words occurs nowhere; one without a name hits like others,
    but is not listed; items of equal text are all named; repeated documents are
    marked alike.
    """
    n_words, n_hit, hits, names = fresh(docs, "n_words", "n_hit", "hits", "items")
    here = docs.withColumns(
        {n_words: F.lit(0).cast("long"), n_hit: F.lit(0).cast("long")}
        | {hits: F.lit(None).cast(HITS), names: F.lit(None).cast("array<string>")}
    )
    schema, at = here.schema, here.columns.index(text_col)
    for k, (automaton, names_of) in enumerate(automata(items, item_col, item_text_col, window, shard_bytes)):
        shared = broadcast_state(docs.sparkSession, automaton)
        shared_names = docs.sparkSession.sparkContext.broadcast(names_of)

        def run(batches, shared=shared, shared_names=shared_names):
            automaton, names_of = with_state(Automaton, shared), shared_names.value
            for batch in batches:
                old = [batch.column(n) for n in range(batch.num_columns - 4, batch.num_columns)]
                n_words = np.zeros(batch.num_rows, np.int64)
                n_hit, ranges, names = old[1].to_numpy(zero_copy_only=False).copy(), old[2].to_pylist(), old[3].to_pylist()
                for low, high, raw, offsets in text_slices(batch.column(at)):
                    n_words[low:high], found = automaton.scan(raw, offsets)
                    for of, (new, found_names) in found.items():
                        row, flat = low + of, ranges[low + of] or []
                        done = merged(new + [flat[n : n + 2] for n in range(0, len(flat), 2)])
                        ranges[row] = [x for pair in done for x in pair]
                        n_hit[row] = sum(b - a for a, b in done)
                        names[row] = sorted(set(names[row] or ()).union(*(names_of[name] for name in found_names)))
                new = [pa.array(n_words), pa.array(n_hit, pa.int64()), pa.array(ranges, old[2].type), pa.array(names, old[3].type)]
                rest = [batch.column(n) for n in range(batch.num_columns - 4)]
                yield pa.RecordBatch.from_arrays([*rest, *new], batch.schema.names)

        here = here.mapInArrow(run, schema)
        if k % 4 == 3:
            here = written(here)
    return here


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``items`` (sorted names of the items with windows in it)."""
    found = marked(docs.select(id_col, F.col(text_col).cast("string")), items, text_col, **options)
    return found.select(
        id_col,
        found["n_words"],
        found["n_hit"],
        F.coalesce(found["items"], F.array().cast("array<string>")).alias("items"),
    )


def decontaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = 0.5, **options
) -> DataFrame:
    """``docs`` without the spans that stand in test items, and without documents of which more than ``max_coverage`` is hit.

    A span runs from its first hit word to its last. All columns stay, clean
    texts stay as they are, byte for byte; null and empty texts are clean.
    """
    found = marked(docs.withColumn(text_col, F.col(text_col).cast("string")), items, text_col, **options)
    n_words, n_hit, _, names = found.columns[-4:]
    kept = found.filter(found[n_hit] <= max_coverage * found[n_words]).drop(n_words, n_hit, names)
    at, schema = docs.columns.index(text_col), docs.withColumn(text_col, F.col(text_col).cast("string")).schema

    def run(batches):
        for batch in batches:
            hits, texts = batch.column(batch.num_columns - 1), batch.column(at)
            columns = [batch.column(n) for n in range(batch.num_columns - 1)]
            if hits.null_count < len(hits):
                new = texts.to_pylist()
                for row, flat in enumerate(hits.to_pylist()):
                    if flat:
                        new[row] = without(new[row], flat)
                columns[at] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return kept.mapInArrow(run, schema)


def without(text: str, flat: list[int]) -> str:
    """``text`` without the words of the ranges, and what stands between words of one range."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(LOWER[raw], np.array([0, len(raw)]), WORD)
    left, at = [], 0
    for a, b in zip(flat[::2], flat[1::2]):
        left.append(raw[at : starts[a]].tobytes())
        at = int(ends[b - 1])
    left.append(raw[at:].tobytes())
    return b"".join(left).decode()
