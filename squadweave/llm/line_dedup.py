"""Line deduplication by winnowing over line hashes, in native expressions only.

A run is a stretch of whole lines. For each line, the shortest run of at least
``min_words`` words that begins there, and the one that ends there, are windows;
the smallest line hash in a window is its fingerprint. Equal windows select
equal fingerprints, and a run of ``min_words`` words or more always holds whole
windows, so every repeated run is guaranteed to share fingerprints with its
earlier occurrence. Windows that begin and windows that end at a line extend a
match both ways: together they cover a repeated run line by line, to its ends.

Only windows whose fingerprint was selected at more than one place are compared
by their full content. Their first occurrence, by document id and line, stays;
the lines of every later one are deleted. Where a later one overlaps the first,
as in many equal lines, the lines that both share are deleted too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squadweave.llm.common import fresh, written
from squadweave.llm.quality_rules import BLANKS, let, split_words

MIN_WORDS = 50


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``body``, ``line``, ``words``, ``h``: every line with a word, once for documents equal in id and text."""
    hashed = F.transform(
        text_lines(F.col(text_col)),
        lambda x: F.struct(F.size(split_words(x)).alias("words"), F.xxhash64(trimmed(x)).alias("h")),
    )
    each = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col).cast("string")).alias("body"), hashed.alias("lines")
    )
    return (
        each.groupBy("doc", "body")
        .agg(F.first("lines").alias("lines"))
        .select("doc", "body", F.posexplode("lines").alias("line", "x"))
        .select("doc", "body", "line", F.col("x.words").cast("long").alias("words"), F.col("x.h").alias("h"))
        .filter("words > 0")
    )


def windows(all_lines: DataFrame, min_words: int) -> DataFrame:
    """``doc``, ``body``, ``first``, ``last`` (lines), ``fingerprint``, ``at`` (its line), ``key``: both windows of every line."""
    here = Window.partitionBy("doc", "body")
    ahead = here.orderBy("line")
    placed = all_lines.withColumn("after", F.sum("words").over(ahead)).withColumn("before", F.col("after") - F.col("words"))
    least = F.struct("h", "line")

    def seen(over, whole):
        return F.when(
            whole,
            F.struct(
                F.min("line").over(over).alias("first"),
                F.max("line").over(over).alias("last"),
                F.min(least).over(over).alias("least"),
                F.xxhash64(F.lit(1), F.collect_list("h").over(over)).alias("key1"),
                F.xxhash64(F.collect_list("h").over(over), F.lit(2)).alias("key2"),
            ),
        )

    # Lines whose words begin less than min_words after this one's, or end less than min_words before it.
    forth = here.orderBy("before").rangeBetween(0, min_words - 1)
    back = here.orderBy("after").rangeBetween(-(min_words - 1), 0)
    both = placed.select(
        "doc",
        "body",
        seen(forth, F.max("after").over(forth) - F.col("before") >= min_words).alias("forth"),
        seen(back, F.col("after") - F.min("before").over(back) >= min_words).alias("back"),
    )
    found = both.select("doc", "body", F.explode(F.array("forth", "back")).alias("w")).filter("w is not null")
    return found.select(
        "doc", "body", "w.first", "w.last", F.col("w.least.h").alias("fingerprint"), F.col("w.least.line").alias("at"), "w.key1", "w.key2"
    ).distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc``, ``body``, ``cut``: for documents with repeated runs, the numbers of the lines to delete, in order."""
    found = written(windows(lines(docs, id_col, text_col), min_words))
    # Positions selected for a fingerprint, then the fingerprints selected at several.
    places = found.groupBy("fingerprint").agg(
        F.min(F.struct("doc", "body", "at")).alias("low"), F.max(F.struct("doc", "body", "at")).alias("high")
    )
    several = places.filter(~F.col("low").eqNullSafe(F.col("high"))).select("fingerprint")
    suspects = written(found.join(several, "fingerprint"))
    same = ["fingerprint", "key1", "key2"]
    place = F.struct("doc", "body", "first")
    # Written first, so that the join meets plain shuffles of both sides and a window of very many places is split.
    earliest = written(
        suspects.groupBy(*same)
        .agg(F.min(place).alias("origin"), F.max(place).alias("latest"))
        .filter(~F.col("origin").eqNullSafe(F.col("latest")))
        .drop("latest")
    )
    later = suspects.join(earliest, same).filter(~place.eqNullSafe(F.col("origin")))
    return (
        later.select("doc", "body", F.explode(F.sequence("first", "last")).alias("line"))
        .groupBy("doc", "body")
        .agg(F.sort_array(F.collect_set("line")).alias("cut"))
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` without repeated runs of lines; all columns stay, and ``lines_cut``, added or replaced, counts the lines deleted.

    Lines are compared without the blanks around them; lines without a word
    belong to no run and stay, except between deleted lines. Rows equal in id
    and text are one document and are cut alike. A null id comes before all
    others, null and empty texts stay as they are, untouched texts stay byte for byte.
    """
    doc, body, lines_cut, here = fresh(docs, "doc", "body", "cut", "here")
    cut = repeated_lines(docs, id_col, text_col, min_words).toDF(doc, body, lines_cut)
    both = docs.withColumn(here, F.xxhash64(F.col(text_col).cast("string"))).join(
        cut, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(here) == F.col(body)), "left"
    )
    cut_here = F.col(lines_cut)
    kept = let(
        text_lines(F.col(text_col)),
        lambda all_lines: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), cut_here), lambda at: F.get(all_lines, at)
        ),
    )
    text = F.when(cut_here.isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return both.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "lines_cut"],
        F.coalesce(F.size(cut_here), F.lit(0)).cast("long").alias("lines_cut"),
    )
