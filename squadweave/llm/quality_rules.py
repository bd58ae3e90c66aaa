"""Quality rules as a short-circuit cascade, in native expressions only.

Every rule is a condition that rejects a document. On a bounded sample each
rule's time and the share it rejects are measured; the cascade then tries rules
by rejections per cost, and a document leaves it at the first that rejects it.
The order decides what the cascade costs, never its verdict: any rule rejects.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import written

BLANKS = " \t\n\x0b\f\r"
REPEAT_WINDOW = 8
# Documents of the sample on which rules are timed; a larger table adds none.
SAMPLE_ROWS = 2000

_POSITION = (1 << 31) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def count_chars(text: Column, others: str) -> Column:
    """How many characters are left of a text without ``others``, a class of all the rest."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), others, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return count_chars(text, "[^#*$%&|<>]++")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def n_dup_lines(text: Column) -> Column:
    return let(worded_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def _twins(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """The entries of a sorted array that have the same key as a neighbour."""
    return F.filter(
        ordered,
        lambda x, i: F.coalesce(key(x) == key(F.get(ordered, i - 1)), F.lit(False))
        | F.coalesce(key(x) == key(F.get(ordered, i + 1)), F.lit(False)),
    )


def n_repeat_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """How many words stand in windows of ``window`` words that the text has twice or more.

    Each window is one number, 33 bits of hash above 31 bits of position, so
    sorting numbers brings windows that may be equal together; those few are
    compared word by word.
    """

    def by_hash(words):
        starts = F.sequence(F.lit(1), F.size(words) - (window - 1))
        hashed = F.transform(
            starts,
            lambda at: F.shiftleft(F.xxhash64(F.slice(words, at, F.lit(window))), 31).bitwiseOR(at.cast("long")),
        )
        return let(F.sort_array(hashed), lambda s: _twins(s, lambda x: F.shiftright(x, 31)))

    def exact(words, suspects):
        entries = F.transform(
            suspects,
            lambda x: let(
                x.bitwiseAND(F.lit(_POSITION)).cast("int"),
                lambda at: F.struct(F.array_join(F.slice(words, at, F.lit(window)), " ").alias("w"), at.alias("at")),
            ),
        )
        twins = let(F.sort_array(entries), lambda s: _twins(s, lambda x: x["w"]))
        return F.sort_array(F.transform(twins, lambda x: x["at"]))

    def covered(places):
        steps = F.transform(
            places, lambda at, i: F.least(F.coalesce(F.get(places, i + 1) - at, F.lit(window)), F.lit(window))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    none = F.lit(0).cast("long")
    found = let(
        by_hash(words),
        lambda suspects: F.when(F.size(suspects) == 0, none).otherwise(let(exact(words, suspects), covered)),
    )
    return F.when(F.size(words) < window, none).otherwise(found)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What rules count, by name."""
    return {
        "word_chars": word_chars(words),
        "n_symbols": n_symbols(text),
        "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(words),
    }


def rules(text: Column, words: Column, counted: dict[str, Column] | None = None) -> dict[str, Column]:
    """The conditions that reject, by name; ``counted`` gives measures that stand in columns already."""
    n, by = F.size(words), counted or measures(text, words)
    return {
        "few_words": n < 20,
        "repeats_itself": 100 * by["n_repeat_words"] > 30 * n,
        "stutters": 100 * F.size(F.filter(words, lambda x, i: x == F.get(words, i + 1))) > 40 * n,
        "symbols": 100 * by["n_symbols"] > 30 * n,
        "shouts": 100 * count_chars(text, "[^!]++") > 50 * n,
        "word_length": (by["word_chars"] < 2 * n) | (by["word_chars"] > 15 * n),
        "few_letters": 100 * count_chars(text, "[^\\p{L}]++") < 60 * by["word_chars"],
        "repeated_lines": 100 * by["n_dup_lines"] > 60 * F.size(worded_lines(text)),
    }


class Cascade:
    """Rules in the order in which they reject most per second."""

    def __init__(self, measured: dict[str, tuple[float, float]]):
        self.measured = measured
        self.order = sorted(measured, key=lambda name: (-measured[name][1] / measured[name][0], name))

    def rejected_by(self, text: Column, words: Column, counted: dict[str, Column] | None = None) -> Column:
        """The first rule that rejects, null where none does; later rules are not evaluated."""
        conditions, chain = rules(text, words, counted), F
        for name in self.order:
            chain = chain.when(conditions[name], F.lit(name))
        return chain

    def verdict(self, text: Column) -> Column:
        """The same from the text alone, whose words are split once, wherever the expression is moved to."""
        return let(split_words(text), lambda words: self.rejected_by(text, words))


def measure(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Cascade:
    """Time every rule, and count what it rejects, on about ``sample_rows`` documents picked by a hash of their text."""
    total = docs.count()
    share = min(1.0, sample_rows / max(1, total))
    picked = F.pmod(F.xxhash64(F.lit("sample"), F.col(text_col)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = written(docs.filter(picked).select(F.col(text_col).cast("string").alias("text")))
    words = sample.withColumn("words", split_words(F.col("text")))
    rows = max(1, sample.count())
    measured = {}
    for name, rejects in rules(F.col("text"), F.col("words")).items():
        query = words.agg(F.count_if(rejects))
        query.first()
        start = time.perf_counter()
        hits = query.first()[0]
        measured[name] = (max(1e-6, time.perf_counter() - start) / rows, hits / rows)
    return Cascade(measured)


def judged(docs: DataFrame, cascade: Cascade | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``rejected_by``, the first rule of the cascade that rejects a document, or null.

    Null and empty texts have no words and are rejected as such; repeated rows
    get the same verdict; all columns stay, but one of that name is replaced.
    """
    verdict = (cascade or measure(docs, text_col)).verdict(F.col(text_col).cast("string"))
    return docs.select(*[c for c in docs.columns if c != "rejected_by"], verdict.alias("rejected_by"))


def passing(docs: DataFrame, cascade: Cascade | None = None, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    return docs.filter((cascade or measure(docs, text_col)).verdict(F.col(text_col).cast("string")).isNull())


def statistics(docs: DataFrame, cascade: Cascade | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the counts that rules rest on, ``base_failed``, and ``kept``, the cascade's verdict."""
    cascade = cascade or measure(docs, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(id_col, text.alias("_text")).withColumn("_words", split_words(F.col("_text")))
    text, words = F.col("_text"), F.col("_words")
    counted = split.select(
        id_col,
        "_text",
        "_words",
        F.size(words).cast("long").alias("n_words"),
        *[count.alias(name) for name, count in measures(text, words).items()],
    )
    known = {name: F.col(name) for name in measures(text, words)}
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(cascade.rejected_by(text, words, known).isNull()).alias("kept"),
    )
