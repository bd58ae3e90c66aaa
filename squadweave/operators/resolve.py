"""Entity resolution: canonical names, mappings, collapsed duplicates.

``canonicalize`` works on distinct names and in two tiers. Names that contain
a canonical one, or lie within one, meet through an equi-join on substrings.
Only what is left is scored, in cells of a bounded number of names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.functions.similarity import match_batches, pair_scores
from squadweave.functions.text import normalize_name, sort_tokens
from squadweave.operators.candidates import SHARE, partial_candidates, whole_candidates
from squadweave.session import bind, bucket, cut_lineage, single_value
from squadweave.sources.tables import present

# Lengths of the runs that give join keys. A string uses the largest that fits it,
# so that long strings meet on long, rare keys.
LEVELS = (1, 2, 3, 6, 12, 24, 48, 96)

# A key is hot when it holds more than this share of all key rows; there can be
# at most ``1 / HOT_SHARE`` hot ones.
HOT_SHARE = 0.001

# Names per side of a scoring cell, and characters to a name beyond which it takes fewer.
CELL = 1 << 15
CELL_CHARACTERS = 32

# Few names are still dealt to some cells, as names are few bytes but much work: buckets of so many at least, up to
# so many buckets where all names meet, and where only those of like length do.
LEAST_CELL, SPREAD, SPREAD_BAND = 1 << 10, 8, 3
# Cells are dealt to so many tasks, or to as many as the session's shuffles have, if those are more.
CELL_TASKS = 128

# From this cutoff on, what two matching strings must share is longer than a character on average.
INDEXED = 75.0

# So few pairs are scored in less time than keys are made: a quarter of the largest cell.
FEW_PAIRS = CELL * CELL // 4


def _level(text: Column) -> Column:
    return F.greatest(*[F.when(F.length(text) >= level, F.lit(level)) for level in LEVELS])


def _minimizers(text: Column, level: int) -> Column:
    """Distinct keys of ``text``: of every run of ``level`` characters the least hash of its substrings of one size.

    A run of ``level`` characters has ``level // 3 + 1`` substrings of the size
    taken, so two of ``level // 3 + 2`` substrings become keys. A text that
    lies in another shares all its runs with it, and so all its keys.
    """
    window = level // 3 + 1
    size = level + 1 - window
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    hashes = F.transform(starts, lambda start: F.xxhash64(F.lit(level), F.substr(text, start, F.lit(size))))
    if window == 1:
        return F.array_distinct(hashes)
    least = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - window + 1), lambda at: F.array_min(F.slice(h, at, window)))
    return F.array_distinct(bind(hashes, least))


def contained_pairs(shorts: DataFrame, longs: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """Pairs ``(short, long)`` with ``short`` a substring of ``long``, equal strings included.

    The first column of both inputs holds distinct, non-empty texts; further
    columns go along, so that no later join has a popular text as its key. A
    short text looks for its rarest key among those of the long texts, at the
    greatest level that fits it; one that lacks any of its keys there lies in
    none. Hot keys are split: their long texts over salts, their short texts
    copied to each salt.
    """
    with_short, with_long = shorts.columns[1:], longs.columns[1:]
    shorts = shorts.toDF("short", *with_short).withColumn("size", _level(F.col("short")))
    keys_of = lambda text: F.coalesce(*[F.when(F.col("size") == level, _minimizers(F.col(text), level)) for level in LEVELS])
    short_keys = shorts.select("short", *with_short, F.explode(keys_of("short")).alias("key"))
    sizes = single_value(shorts, F.collect_set("size"))
    long_keys = cut_lineage(
        longs.toDF("long", *with_long)
        .withColumn("size", F.explode(F.array_intersect(F.array(*map(F.lit, LEVELS)), sizes)))
        .filter(F.col("size") <= F.length("long"))
        .select("long", *with_long, F.explode(keys_of("long")).alias("key"))
    )
    frequency = long_keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    keys = single_value(frequency, F.sum("n"))
    hot = frequency.select("key", F.ceil(F.col("n") / (keys * hot_share)).cast("int").alias("salts")).filter("salts > 1")
    rarest = (
        short_keys.join(frequency, "key", "left")
        .groupBy("short", *with_short)
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("rarest"))
        .filter(F.col("rarest.n") > 0)
        .select("short", *with_short, "rarest.key")
        .join(F.broadcast(hot), "key", "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .select("short", *with_short, "key", "salt")
    )
    spread = long_keys.join(F.broadcast(hot), "key", "left").withColumn(
        "salt", bucket(F.col("long"), F.coalesce("salts", F.lit(1)))
    )
    return (
        spread.select("long", *with_long, "key", "salt")
        .join(rarest, ["key", "salt"])
        .filter(F.contains("long", "short"))
        .select("short", "long", *with_short, *with_long)
    )


def _band(text: Column, scorer: str, cutoff: float) -> tuple[Column, tuple[int, ...]]:
    """Length band of a text, and how far the bands of two matching texts can lie apart.

    Two whole texts that reach the cutoff differ in length by a bounded
    factor. A part of a text can match whatever the lengths are.
    """
    if scorer == "partial" or cutoff <= 0:
        return F.lit(0), (0,)
    if cutoff >= 100:
        return F.length(text), (0,)
    factor = (200.0 - cutoff) / cutoff * (1 + 1e-9)
    band = F.floor(F.log(F.length(text).cast("double")) / math.log(factor)).cast("int")
    return F.when(F.length(text) > 0, band).otherwise(-2), (-1, 0, 1)


def _in_cells(rows: DataFrame, own: str, others: DataFrame, other: str, near: tuple[int, ...]) -> DataFrame:
    """``rows`` with their own bucket, once for every bucket of the other side that they must meet.

    There are no more bands than lengths of text, so the tables of bucket
    counts are small whatever the data.
    """
    spread = SPREAD if len(near) == 1 else SPREAD_BAND

    def sides(df: DataFrame, side: str) -> DataFrame:
        many, characters = F.count(F.lit(1)), F.sum(F.length(F.col(df.columns[0])))
        whole = F.ceil(F.greatest(many / CELL, characters / (CELL * CELL_CHARACTERS)))
        some = F.least(F.lit(spread), F.ceil(many / LEAST_CELL))
        return df.groupBy(F.col("band").alias(f"{side}_band")).agg(F.greatest(whole, some).cast("int").alias("buckets"))

    key = F.col(rows.columns[0])
    placed = rows.withColumnRenamed("band", f"{own}_band").join(F.broadcast(sides(rows, own)), f"{own}_band")
    placed = placed.withColumn(f"{own}_bucket", bucket(key, F.col("buckets"))).drop("buckets")
    steps = F.array(*[F.col(f"{own}_band") + step for step in near])
    return (
        placed.withColumn(f"{other}_band", F.explode(steps))
        .join(F.broadcast(sides(others, other)), f"{other}_band")
        .withColumn(f"{other}_bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))
        .drop("buckets")
    )


def fuzzy_pairs(
    names: DataFrame, canon: DataFrame, scorer: str, cutoff: float, best: bool = False, share: float = SHARE
) -> DataFrame:
    """Pairs ``(name, canon, seq, score)`` that score at least ``cutoff``.

    ``names`` has the column ``name``, ``canon`` the columns ``canon`` and
    ``seq``; both are distinct. From a cutoff of ``INDEXED`` on, strings meet
    through join keys that no pair at the cutoff can lack; below it, pairs need
    share no more than single characters. Strings whose keys do not tell them
    apart, which at low cutoffs and in short strings are all, and those below that
    cutoff are scored in cells. ``share`` is how much of the other side a
    string's keys may meet. With ``best`` cells return their best pairs only.
    """
    names, canon = cut_lineage(names.select("name")), cut_lineage(canon.select("canon", "seq"))
    if names.count() * canon.count() <= FEW_PAIRS:
        return _cell_pairs(names, canon, scorer, cutoff, best)
    if not INDEXED <= cutoff < 100 or scorer not in ("ratio", "partial"):
        return _all_pairs(names, canon, scorer, cutoff, best)
    if scorer == "ratio":
        pairs, up = whole_candidates(names, canon, cutoff, share)
        return _scored(pairs, scorer, cutoff).unionByName(_all_pairs(cut_lineage(up), canon, scorer, cutoff, best))
    short, names_up = partial_candidates(names, canon, cutoff, share=share)
    names_up = cut_lineage(names_up)
    rest = cut_lineage(names.join(names_up, "name", "left_anti"))
    if rest.isEmpty():
        return _all_pairs(names, canon, scorer, cutoff, best)
    long, canon_up = partial_candidates(canon, names, cutoff, longer=True, share=share)
    needles = cut_lineage(canon.join(canon_up, "canon", "left_semi"))
    return (
        _scored(short.unionByName(long.select(short.columns)), scorer, cutoff)
        .unionByName(_cell_pairs(names_up, canon, scorer, cutoff, best))
        .unionByName(_cell_pairs(rest, needles, scorer, cutoff, best))
        .dropDuplicates(["name", "canon"])
    )


def _all_pairs(names: DataFrame, canon: DataFrame, scorer: str, cutoff: float, best: bool) -> DataFrame:
    """All pairs in cells; where most names are canonical ones too, two of those meet once and are found both ways."""
    if best:
        return _cell_pairs(names, canon, scorer, cutoff, best)
    both = cut_lineage(canon.join(names.select(F.col("name").alias("canon")), "canon", "left_semi"))
    shared, named = both.count(), names.count()
    if 2 * shared <= named:
        return _cell_pairs(names, canon, scorer, cutoff, best)
    found = _cell_pairs(both.select(F.col("canon").alias("name"), "seq"), both, scorer, cutoff, best, mirrored=True)
    if shared < named:
        others = cut_lineage(names.join(both, names["name"] == both["canon"], "left_anti"))
        found = found.unionByName(_cell_pairs(others, canon, scorer, cutoff, best))
    if shared < canon.count():
        others = cut_lineage(canon.join(both.select("canon"), "canon", "left_anti"))
        found = found.unionByName(_cell_pairs(both.select(F.col("canon").alias("name")), others, scorer, cutoff, best))
    return found


def _scored(pairs: DataFrame, scorer: str, cutoff: float) -> DataFrame:
    scored = pairs.withColumn("score", pair_score(F.col("name"), F.col("canon"), scorer))
    return scored.filter(F.col("score") >= cutoff)


def _cell_pairs(
    names: DataFrame, canon: DataFrame, scorer: str, cutoff: float, best: bool, mirrored: bool = False
) -> DataFrame:
    """All pairs in cells.

    Each side is hashed into buckets of at most about ``CELL`` rows of one
    length band, and two buckets of bands that can match are one cell. Work and
    memory per cell are bounded and even whatever the names look like: pairs
    are told apart by their bits, and what a cell finds leaves it in batches.
    With ``best`` a cell returns one row per name: top score, then earliest ``seq``.
    With ``mirrored`` both sides are the same texts, each with its ``seq``: of
    two cells with their sides exchanged one is scored and returns both ways.
    """
    name_band, near = _band(F.col("name"), scorer, cutoff)
    canon_band, _ = _band(F.col("canon"), scorer, cutoff)
    seq_type = canon.schema["seq"].dataType
    seq = F.col("seq") if mirrored else F.lit(None).cast(seq_type)
    left = names.select("name", seq.alias("seq")).withColumn("band", name_band)
    right = canon.select("canon", "seq").withColumn("band", canon_band)
    sides = [["name_band", "name_bucket"], ["canon_band", "canon_bucket"]]
    cell = [*sides[0], *sides[1]]
    name_cells = _in_cells(left, "name", right, "canon", near).select(*cell, F.col("name").alias("text"), "seq", F.lit(True).alias("own"))
    canon_cells = _in_cells(right, "canon", left, "name", near).select(*cell, F.col("canon").alias("text"), "seq", F.lit(False).alias("own"))
    dealt = name_cells.unionByName(canon_cells)
    if mirrored:
        dealt = dealt.filter(F.struct(*sides[0]) <= F.struct(*sides[1]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        left, right = (rows.filter(side).combine_chunks() for side in (rows["own"], pc.invert(rows["own"])))
        if not left.num_rows or not right.num_rows:
            return
        twice = mirrored and any(rows[a][0] != rows[b][0] for a, b in zip(*sides))
        found = match_batches(left["text"].to_pylist(), right["text"].to_pylist(), scorer, cutoff, best)
        for at_left, at_right, scores in _best_of(found, left.num_rows, right["seq"]) if best else found:
            a, b = left.take(pa.array(at_left)), right.take(pa.array(at_right))
            for x, y in ((a, b), (b, a)) if twice else ((a, b),):
                columns = [x["text"], y["text"], y["seq"], pa.array(scores)]
                yield from pa.table(columns, ["name", "canon", "seq", "score"]).to_batches()

    parts = max(CELL_TASKS, int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = f"name string, canon string, seq {seq_type.simpleString()}, score double"
    return dealt.repartition(parts, *cell).groupBy(*cell).applyInArrow(score, found)


def _best_of(found, count: int, seq: pa.ChunkedArray):
    """Of all batches the right one for each left one: top score, then earliest ``seq``."""
    rank = np.empty(len(seq), np.int64)
    rank[pc.sort_indices(seq, null_placement="at_start").to_numpy()] = np.arange(len(seq))
    top, of = np.full(count, -np.inf), np.zeros(count, np.int64)
    for left, right, scores in found:
        order = np.lexsort((rank[right], -scores, left))
        first = order[np.unique(left[order], return_index=True)[1]]
        left, right, scores = left[first], right[first], scores[first]
        better = (scores > top[left]) | ((scores == top[left]) & (rank[right] < rank[of[left]]))
        top[left[better]], of[left[better]] = scores[better], right[better]
    matched = np.flatnonzero(top > -np.inf)
    yield matched, of[matched], top[matched]


def best_match(df: DataFrame, key: str, score: str, seq: str, value: str) -> DataFrame:
    """Per key the value with the top score, the earliest on ties."""
    top = F.struct(-F.col(score), F.col(seq))
    return df.groupBy(key).agg(F.min_by(value, top).alias(value), F.max(score).alias(score))


def _distinct_names(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("name")).filter(F.col("name").isNotNull()).distinct()


def _first_seen(df: DataFrame, column: str, seq: str) -> DataFrame:
    named = df.filter(F.col(column).isNotNull())
    return named.groupBy(F.col(column).alias("canon")).agg(F.min(seq).alias("seq"))


def canonicalize(
    names: DataFrame,
    name: str,
    canon: DataFrame,
    canon_name: str,
    seq: str,
    scorer: str = "partial",
    cutoff: float = 70.0,
) -> DataFrame:
    """Mapping ``(name, canon, score)`` of every distinct name to its best canonical name.

    A name without a canonical one at or above ``cutoff`` maps to itself with
    a null score. The earliest canonical name, by ``seq``, wins a tie; ``seq``
    is a number or a text, and may be the canonical name itself.
    """
    # Distinct names are used many times over, so the tables they come from are read once.
    same = names is canon and name == canon_name
    targets = cut_lineage(_first_seen(canon, canon_name, seq))
    wanted = targets.select(F.col("canon").alias("name")) if same else cut_lineage(_distinct_names(names, name))
    if scorer == "partial":
        sure = _contained_match(wanted, targets, same)
    else:
        sure = wanted.join(targets, F.col("name") == F.col("canon")).select("name", "canon")
    sure = cut_lineage(wanted.join(sure, "name", "left"))
    left_over = sure.filter(F.col("canon").isNull()).select("name")
    if left_over.isEmpty():
        return sure.withColumn("score", F.lit(100.0))
    guessed = best_match(fuzzy_pairs(left_over, targets, scorer, cutoff, best=True), "name", "score", "seq", "canon")
    return (
        sure.join(guessed.withColumnRenamed("canon", "guess"), "name", "left")
        .select(
            "name",
            F.coalesce("canon", "guess", "name").alias("canon"),
            F.when(F.col("canon").isNotNull(), F.lit(100.0)).otherwise(F.col("score")).alias("score"),
        )
    )


def _contained_match(wanted: DataFrame, targets: DataFrame, same: bool) -> DataFrame:
    """Earliest canonical name that contains a name or lies within it: exactly the pairs that score 100.

    With ``same`` both sides hold the same names, and one join serves both ways.
    """
    some = wanted.filter(F.col("name") != "")
    canon = targets.filter(F.col("canon") != "")
    as_short, as_long = (canon.select("canon", F.col("seq").alias(f"{side}_seq")) for side in ("short", "long"))
    around = F.struct(F.col("short").alias("name"), F.col("long").alias("canon"), F.col("long_seq").alias("seq"))
    inside = F.struct(F.col("long").alias("name"), F.col("short").alias("canon"), F.col("short_seq").alias("seq"))
    if same:
        pairs = contained_pairs(as_short, as_long).select(F.explode(F.array(inside, around)).alias("pair"))
    else:
        pairs = contained_pairs(as_short, some).select(inside.alias("pair")).unionByName(
            contained_pairs(some, as_long).select(around.alias("pair"))
        )
    return pairs.select("pair.*").groupBy("name").agg(F.min_by("canon", "seq").alias("canon"))


def token_sort_match(
    names: DataFrame, name: str, canon: DataFrame, canon_name: str, seq: str, cutoff: float = 80.0
) -> DataFrame:
    """Mapping ``(name, canon, score)`` by the words of the normalized names, in any order.

    Names are scored once per sorted word list. The result is the original
    spelling of the earliest canonical name with the best score; a name that
    normalizes to nothing maps to itself.
    """
    words = lambda column: sort_tokens(normalize_name(F.col(column)))
    wanted = _distinct_names(names, name).withColumn("key", words("name"))
    targets = (
        _first_seen(canon, canon_name, seq)
        .withColumn("key", words("canon"))
        .filter(F.col("key") != "")
        .groupBy("key")
        .agg(F.min_by("canon", "seq").alias("canon"), F.min("seq").alias("seq"))
    )
    keys = canonicalize(
        wanted.filter(F.col("key") != "").select("key"), "key", targets, "key", "seq", scorer="ratio", cutoff=cutoff
    )
    found = keys.filter(F.col("score").isNotNull()).join(
        targets.select(F.col("key").alias("target"), F.col("canon").alias("found")), F.col("canon") == F.col("target")
    ).select(F.col("name").alias("key"), "found", "score")
    return wanted.join(found, "key", "left").select("name", F.coalesce("found", "name").alias("canon"), "score")


def lookup(df: DataFrame, column: str, dimension: DataFrame, key: str, value: str, miss: str = "keep") -> DataFrame:
    """``column`` replaced by the ``value`` of its ``key`` in a dimension table.

    An unknown value stays as it is, or is null with ``miss='null'``.
    """
    known = dimension.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    found = F.coalesce("_value", column) if miss == "keep" else F.col("_value")
    return df.join(known, F.col(column) == F.col("_key"), "left").withColumn(column, found).drop("_key", "_value")


def apply_mapping(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``column`` replaced by its canonical name; unmapped values stay."""
    return lookup(df, column, mapping, "name", "canon")


def pair_score(a: Column, b: Column, scorer: str = "ratio") -> Column:
    """Score of two string columns, row by row; null where either is null."""

    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        both = left.notna() & right.notna()
        scores = pd.Series(None, index=left.index, dtype="float64")
        scores[both] = pair_scores(list(left[both]), list(right[both]), scorer)
        return scores

    return score(a, b)


def mapping_diff(mapping: DataFrame) -> DataFrame:
    """The pairs that a resolution changed."""
    return mapping.filter(F.col("name") != F.col("canon"))


def dedup_keep_first(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The first row, by ``seq``, of every key."""
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*seq)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def dedup_metrics(mapping: DataFrame) -> DataFrame:
    """How many names there were, how many are canonical, and how many went away."""
    counted = mapping.agg(
        F.count_distinct("name").alias("original"), F.count_distinct("canon").alias("canonical")
    )
    return counted.withColumn("removed", F.col("original") - F.col("canonical"))


def collapse(df: DataFrame, keys: list[str], text: str, separator: str = " | ") -> DataFrame:
    """One row per key with its distinct texts, sorted and joined. Rows with a null key go away."""
    return present(df, keys).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set(text)), separator).alias(text)
    )
