"""Join keys for fuzzy scores: which pairs of strings can reach a cutoff at all.

Two strings that score high share something that an equi-join finds. Each
function returns candidate pairs that hold every pair at or above the cutoff,
and the strings it gave up: those whose keys would bring more pairs, or be more
keys, than comparing them with everything takes. What is given up depends on
how often keys occur, so the caller scores it another way and loses nothing.

Scores are ``100 * (1 - d / (a + b))``, with ``d`` characters that a common
subsequence of texts of ``a`` and ``b`` characters leaves over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from squadweave.session import bind, cut_lineage, single_value

# A needle whose keys meet more than this share of all texts is compared with all of them instead, and so is a name
# with a key that more than half this share of all rows of keys have. Over check_l, names at a cutoff of 80 took
# longer by keys that meet a hundredth of the texts than all pairs take in cells, where one is ruled out in some 2 ns.
SHARE = 0.001
# Sizes of substrings that a needle is looked up by.
GRAMS = (6, 5, 4, 3, 2)
# Room for rounding in a score.
EPSILON = 1e-9


def _bits(parts: Column) -> Column:
    """64 bits, one hashed from each part of a text and how many like it came before."""
    times = lambda parts, part: F.sequence(F.lit(1), F.size(F.filter(parts, lambda other: other == part)))
    bit = lambda part, time: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(part, time), F.lit(64)).cast("int"))
    bits_of = lambda parts: F.flatten(
        F.transform(F.array_distinct(parts), lambda part: F.transform(times(parts, part), lambda time: bit(part, time)))
    )
    return F.aggregate(bind(parts, bits_of), F.lit(0).cast("long"), lambda mask, bit: mask.bitwiseOR(bit))


def _pairs_of_characters(text: Column) -> Column:
    starts = F.when(F.length(text) > 1, F.sequence(F.lit(1), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda start: F.substr(text, start, F.lit(2)))


def numbered(texts: DataFrame, side: str) -> DataFrame:
    """A written table of texts with what rows of keys carry: a number, the length and the bits of each, named after ``side``."""
    text = F.col(texts.columns[0])
    bits = {f"{side}_ones": _bits(F.split(text, "")), f"{side}_twos": _bits(_pairs_of_characters(text))}
    return cut_lineage(texts.withColumns({f"{side}_size": F.length(text), f"{side}_id": F.monotonically_increasing_id()} | bits))


def _carried(side: str) -> list[str]:
    return [f"{side}_{name}" for name in ("id", "size", "ones", "twos")]


def _in_common(own: str, other: str, parts: str) -> Column:
    """At most so many characters, or pairs of neighbours, does a text share with another.

    Each of its bits that the other lacks is one lost.
    """
    lost = F.bit_count(F.col(f"{own}_{parts}").bitwiseAND(F.bitwise_not(f"{other}_{parts}")))
    return F.col(f"{own}_size") - (1 if parts == "twos" else 0) - lost


def _meet(met: DataFrame, index: DataFrame, can: Column, pair: list[str]) -> DataFrame:
    """Distinct ``pair`` columns of what shares a key and can match.

    An index holds each text many times over, so its files are far smaller than
    its rows; it is merged, as a broadcast chosen by the files' size would not fit the driver.
    """
    return met.join(index.hint("merge"), "key").filter(can).select(*pair).distinct()


def _alike(texts: Column, df: DataFrame) -> Column:
    """The chance that two characters taken anywhere are the same, by how often each occurs."""
    each = df.select(F.explode(F.split(texts, "")).alias("character")).filter("character <> ''").groupBy("character").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    return F.coalesce(single_value(each, F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))), F.lit(0.0))


def edits(a: Column, b: Column, cutoff: float) -> Column:
    """The most characters that texts of these lengths may leave over; of the parity of their sum, as every such number is."""
    most = F.floor((a + b) * (1 - cutoff / 100) + EPSILON).cast("int")
    return most - F.pmod(most + a + b, F.lit(2))


def _segment(length: Column, k: Column, j: Column) -> Column:
    """Where segment ``j`` of ``k + 1`` begins."""
    return F.floor(j * length / (k + 1)).cast("int")


def _key(length: Column, k: Column, j: Column, content: Column) -> Column:
    return F.xxhash64(length, k, j, content)


def whole_candidates(names: DataFrame, texts: DataFrame, cutoff: float, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(name, canon, seq)`` that may score ``cutoff`` as whole strings, and the names given up.

    A pigeonhole index: ``k`` characters left over touch at most ``k`` of
    ``k + 1`` segments of a text, so one stands in the name as it is. Going
    from the left, some untouched segment ``j`` has exactly ``j`` characters
    left over before it, which bounds how far it moved, and says whether by an
    odd or an even number. Keys are (length, k, segment, content).

    ``names`` has the column ``name``, ``texts`` the columns ``canon`` and
    ``seq``; both distinct. Only for cutoffs above 200 / 3, where every segment
    holds a character.
    """
    if cutoff <= 200 / 3:
        raise ValueError("segments need a cutoff above 200 / 3")
    factor = (200 - cutoff) / cutoff
    a, b, k, j, shift = (F.col(name) for name in ("needle_size", "text_size", "k", "j", "shift"))
    near = lambda one, other: (other <= one * factor + EPSILON) & (one <= other * factor + EPSILON)
    can = lambda one, other: near(one, other) & (edits(one, other, cutoff) >= F.abs(one - other))
    sizes = texts.groupBy(F.length("canon").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    many = F.coalesce(single_value(sizes, F.sum("n")), F.lit(0))
    of_texts = single_value(sizes, F.collect_list(F.struct("size", "n")))

    # What a name's keys may meet is told by its length before any key is made.
    lengths = F.filter("of_texts", lambda x: can(a, x["size"]))
    keys = lambda x: (edits(a, x["size"], cutoff) + 2) * (edits(a, x["size"], cutoff) + 2) / 4.0
    meets = lambda x: x["n"] * keys(x) * F.pow(F.col("alike"), x["size"] / (edits(a, x["size"], cutoff) + 1))
    summed = lambda of: F.aggregate("lengths", F.lit(0.0), lambda n, x: n + of(x))
    of_sizes = (
        names.select(F.length("name").alias("needle_size"))
        .distinct()
        .withColumns({"of_texts": of_texts, "alike": _alike(F.col("canon"), texts)})
        .withColumn("lengths", lengths)
        .withColumn("own", (summed(keys) <= many * share * 4) & (summed(meets) <= many * share))
        .select("needle_size", F.transform("lengths", lambda x: x["size"]).alias("lengths"), "own")
    )
    sized = cut_lineage(names.withColumn("needle_size", F.length("name")).join(F.broadcast(of_sizes), "needle_size"))
    if sized.filter("own").isEmpty():
        schema = StructType([*names.schema, *texts.select("canon", "seq").schema])
        return names.sparkSession.createDataFrame([], schema), names
    up, sized = sized.filter(~F.col("own")).select("name"), sized.filter("own")
    of_names = single_value(sized, F.collect_set(a))
    sized = sized.join(numbered(sized.select("name"), "needle").drop("needle_size"), "name")
    size_can = F.exists("of_names", lambda x: can(x, F.length("canon")))
    texts = numbered(texts.withColumn("of_names", of_names).filter(size_can).drop("of_names"), "text")

    ks = F.array_distinct(F.transform(F.filter("of_names", lambda x: can(x, b)), lambda x: edits(x, b, cutoff)))
    index = cut_lineage(
        texts.withColumn("of_names", of_names)
        .withColumn("k", F.explode(ks))
        .withColumn("j", F.explode(F.sequence(F.lit(0), k)))
        .withColumn("start", _segment(b, k, j))
        .withColumn("content", F.substr("canon", F.col("start") + 1, _segment(b, k, j + 1) - F.col("start")))
        .select(_key(b, k, j, F.col("content")).alias("key"), "canon", "seq", *_carried("text")[1:])
    )

    text = F.col("length")
    probes = lambda some: (
        some.select("name", *_carried("needle"), F.explode("lengths").alias("length"))
        .withColumn("k", edits(a, text, cutoff))
        .withColumn("j", F.explode(F.sequence(F.lit(0), k)))
        .withColumn("shift", F.explode(F.sequence(-j, j, F.lit(2))))
        .filter(F.abs(a - text - shift) <= k - j)
        .withColumn("start", _segment(text, k, j))
        .withColumn("part", _segment(text, k, j + 1) - F.col("start"))
        .filter((F.col("start") + shift >= 0) & (F.col("start") + shift + F.col("part") <= a))
        .select(_key(text, k, j, F.substr("name", F.col("start") + shift + 1, F.col("part"))).alias("key"), "name", *_carried("needle"))
    )
    # At most ``2 / share`` keys are that frequent.
    rows = single_value(index, F.count(F.lit(1)))
    hot = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows * (share / 2)).select("key")
    dear = cut_lineage(probes(sized).join(F.broadcast(hot), "key", "left_semi").select("needle_id").distinct())
    most = edits(a, b, cutoff)
    shared = ((a + b - most) / 2).cast("int")
    enough = [
        F.least(_in_common("needle", "text", parts), _in_common("text", "needle", parts)) for parts in ("ones", "twos")
    ]
    # A change of a character is one edit to Levenshtein and two here, so no match has more edits there than here.
    close = F.call_function("levenshtein", F.col("name"), F.col("canon"), F.greatest(most, F.lit(0))) >= 0
    can = (enough[0] >= shared) & (enough[1] >= shared - most - 1) & close
    cheap = probes(sized.join(dear, "needle_id", "left_anti")).drop("needle_id")
    pairs = _meet(cheap, index, can, ["name", "canon", "seq"])
    return pairs, up.unionByName(sized.join(dear, "needle_id", "left_semi").select("name"))


def _shared(m: Column, q: int, cutoff: float) -> Column:
    """How many substrings of ``q`` characters a text surely shares with a needle of ``m`` that it matches partially.

    A window of ``w`` characters that shares ``c`` with the needle leaves
    ``m + w - 2 * c`` over, so the shared ones lie in one run more at most, and
    each run is ``q - 1`` substrings short of its characters. The least window
    that can match at all, all of it shared, gives the fewest.
    """
    rate = ((2 * q - 1) * cutoff / 200 - (q - 1)) * 200 / (200 - cutoff)
    return F.ceil(m * max(rate, 0.0) - (q - 1) - EPSILON).cast("int")


def _grams(text: Column, q: Column) -> Column:
    """Keys of the distinct substrings of ``q`` characters."""
    size = F.length(text)
    starts = F.when(size >= q, F.sequence(F.lit(1), size - q + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda start: F.xxhash64(q, F.substr(text, start, q))))


def partial_candidates(
    needles: DataFrame, texts: DataFrame, cutoff: float, longer: bool = False, share: float = SHARE
) -> tuple[DataFrame, DataFrame]:
    """Pairs of a needle and a text no shorter, or only longer, that may score ``cutoff`` partially, and the needles given up.

    An inverted index of substrings: a needle that must share ``t`` of its
    ``g`` substrings of some size with a text shares one at least of any
    ``g - t + 1`` of them, so it is looked up by its rarest ones. The size is
    the largest of which one must be shared. A needle too short for that, or
    made of repetitions, is given up.

    The first columns of both hold distinct texts; further ones go along.
    """
    columns = [*needles.columns, *texts.columns]
    needle, text = needles.columns[0], texts.columns[0]
    m = F.length(needle)
    many, length = (single_value(texts, of) for of in (F.count(F.lit(1)), F.avg(F.length(text))))
    q = F.coalesce(*[F.when(_shared(m, size, cutoff) >= 1, F.lit(size)) for size in GRAMS])
    shared = F.coalesce(*[F.when(q == size, _shared(m, size, cutoff)) for size in GRAMS])
    # What a needle's keys may meet is told by its length before any key is made.
    meets = F.col("keep") * length * F.pow(_alike(F.col(text), texts), F.col("q"))
    sized = needles.withColumns({"q": q, "keep": m - q + 1 - shared + 1})
    keyed = cut_lineage(sized.filter(F.col("q").isNotNull() & (meets <= share)))
    if keyed.isEmpty():
        schema = StructType([*needles.schema, *texts.schema])
        return needles.sparkSession.createDataFrame([], schema), needles.select(needle)
    up = needles.join(keyed, needle, "left_anti").select(needle)
    needles = numbered(keyed.select(needles.columns), "needle")
    texts = numbered(texts, "text")
    m = F.col("needle_size")
    keyed = needles.join(keyed.select(needle, "q", "keep"), needle).withColumn("keys", _grams(F.col(needle), F.col("q")))
    enough = F.coalesce(F.col("keep") <= F.size("keys"), F.lit(False))
    up = up.unionByName(keyed.filter(~enough).select(needle))

    index = cut_lineage(
        texts.withColumn("q", F.explode(single_value(keyed, F.collect_set("q"))))
        .withColumn("key", F.explode(_grams(F.col(text), F.col("q"))))
        .select("key", *_carried("text"))
    )
    frequency = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("needle_id").orderBy("n", "key")
    met = cut_lineage(
        keyed.filter(enough)
        .select(*_carried("needle"), "keep", F.explode("keys").alias("key"))
        .join(frequency, "key", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("place", F.row_number().over(rarest))
        .filter((F.col("place") <= F.col("keep")) & (F.col("n") > 0))
        .select("key", "n", *_carried("needle"))
    )
    dear = met.groupBy("needle_id").agg(F.sum("n").alias("n")).filter(F.col("n") > many * share).select("needle_id")
    cheap = met.drop("n").join(dear, "needle_id", "left_anti")
    room = F.col("text_size") - m
    can = (
        (room > 0 if longer else room >= 0)
        & (_in_common("needle", "text", "ones") * (200 - cutoff) >= m * cutoff - EPSILON)
        & (_in_common("needle", "text", "twos") >= _shared(m, 2, cutoff))
    )
    plain = lambda df, side: df.drop(*[name for name in _carried(side) if name != f"{side}_id"]).hint("merge")
    found = _meet(cheap, index, can, ["needle_id", "text_id"])
    pairs = found.join(plain(needles, "needle"), "needle_id").join(plain(texts, "text"), "text_id").select(columns)
    return pairs, up.unionByName(needles.join(dear, "needle_id", "left_semi").select(needle))
