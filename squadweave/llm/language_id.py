"""Language identification by compression.

Each language has a zstandard raw-content dictionary of sample text. A text is
encoded with every dictionary, in blocks, and belongs to the language whose
dictionary leaves the fewest bytes; where the runner-up is nearly as small, the
verdict is marked as rejected.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import written

# A language's dictionary is drawn from about this many of its distinct training texts, picked by a hash, and has at most
# this many bytes.
SAMPLE_DOCUMENTS = 400
DICTIONARY_BYTES = 1 << 16
# All dictionaries together have at most this many bytes; where there are very many languages, each gets a smaller one.
ALL_BYTES = 1 << 26
# Long texts are encoded in blocks, so that what a text says itself does not outweigh the dictionary.
BLOCK_BYTES = 2048
# Short texts are encoded in several orders of their words, as sizes are whole bytes.
SHORT_BYTES = 400
MIN_MARGIN = 0.01
# Matches of three bytes tell languages apart. Where the quick search leaves a margin below NARROW, a thorough one decides.
QUICK = {"level": 3, "strategy": zstandard.STRATEGY_LAZY2}
THOROUGH = {"level": 9, "strategy": zstandard.STRATEGY_BTLAZY2}
NARROW = 0.08
UNKNOWN = "und"

# ASCII letters stay, other ASCII becomes a blank; bytes of further letters stay as they are.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))


def in_training(id_col: Column, folds: int = 4, held_out: int = 2) -> Column:
    """All documents but those whose crc32 modulo ``folds`` is ``held_out``; a null id is in."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds != held_out, F.lit(True))


def plain_words(text: str) -> list[bytes]:
    """The words that count: lower-case runs of letters."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def piece(raw: bytes, most_bytes: int) -> bytes:
    """At most ``most_bytes`` of ``raw``, from a place that its hash chooses, where a word starts if one does nearby."""
    if len(raw) <= most_bytes:
        return raw
    at = zlib.crc32(raw) % (len(raw) - most_bytes + 1)
    word = raw.rfind(b" ", max(0, at - 64), at) + 1
    return raw[word or at :][:most_bytes]


def dictionary(pieces: list[bytes], most_bytes: int) -> bytes:
    """Sample text for one language: an equal part of each distinct text's words, in a fixed order."""
    return b" ".join(sorted(set(pieces)))[:most_bytes]


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    all_bytes: int = ALL_BYTES,
) -> dict[str, bytes]:
    """A dictionary per language found in ``docs``, the training documents, the most common language first.

    Rows without language or without a letter teach nothing; texts of any length teach. About ``sample_documents``
    of a language's distinct texts are picked, all where there are fewer and one at least. Tasks cut each text to its
    share of the dictionary, so what reaches the driver is about as large as the dictionaries, at most ``all_bytes``
    of them (but for 64 bytes of each text).
    """
    steps = 1 << 30
    known = (
        docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .filter(F.col("text").rlike("\\p{L}") & F.col("lang").isNotNull())
        .withColumn("hash", F.xxhash64(F.lit("sample"), "text"))
    )
    place = F.pmod("hash", F.lit(steps))
    # Copies are one text; each is picked or left with all its copies.
    distinct = written(known.groupBy("lang", "hash").agg(F.count("*").alias("rows")))
    share = F.floor(F.lit(sample_documents * steps).cast("double") / F.col("texts")).cast("long")
    limits = (
        distinct.groupBy("lang")
        .agg(F.sum("rows").alias("n"), F.count("*").alias("texts"), F.min(place).alias("least"))
        .select("lang", "n", F.least(F.lit(steps), F.greatest(share, F.col("least") + 1)).alias("limit"))
    )
    picked = distinct.join(limits, "lang").filter(place < F.col("limit"))
    shares = written(picked.groupBy("lang").agg(F.first("n").alias("n"), F.first("limit").alias("limit"), F.count("*").alias("texts")))
    order = [row.lang for row in shares.select("lang").orderBy(F.desc("n"), "lang").collect()]
    most = min(dictionary_bytes, all_bytes // max(1, len(order)))
    chosen = known.join(shares, "lang").filter(place < F.col("limit")).select("lang", "texts", "text").distinct()

    def run(batches):
        for batch in batches:
            pieces = [
                piece(b" ".join(plain_words(text)), max(64, most // texts))
                for texts, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pieces, pa.binary())], ["lang", "words"])

    pieces = defaultdict(list)
    for row in chosen.mapInArrow(run, "lang string, words binary").toLocalIterator():
        pieces[row.lang].append(bytes(row.words))
    return {lang: dictionary(pieces[lang], most) for lang in order}


def encoders(dictionaries: dict[str, bytes], level: int, strategy: int) -> list[zstandard.ZstdCompressor]:
    """One prepared compressor per language."""
    made = []
    for raw in dictionaries.values():
        raw = raw or b" " * 8
        how = zstandard.ZstdCompressionParameters.from_level(
            level,
            dict_size=len(raw),
            source_size=BLOCK_BYTES,
            min_match=3,
            strategy=strategy,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        shared = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(compression_params=how)
        made.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=how))
    return made


class Compressors:
    """Encodes texts with every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], short_bytes: int = SHORT_BYTES):
        self.languages = list(dictionaries)
        self.short_bytes = short_bytes
        self.searches = [encoders(dictionaries, **how) for how in (QUICK, THOROUGH)]

    def sizes(self, words: list[bytes], search: list[zstandard.ZstdCompressor]) -> list[int]:
        """Bytes of the text under every dictionary."""
        raw = b" ".join(words)
        if len(raw) <= self.short_bytes:
            blocks = [raw, b" ".join(words[::-1]), b" ".join(sorted(words)), b" ".join(words[1::2] + words[::2])]
        else:
            blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(encoder.compress(block)) for block in blocks) for encoder in search]

    def verdict(self, text: str) -> tuple[str, float]:
        """The language, and by what share of the runner-up's size it is smaller; the one with most training documents wins a tie."""
        words = plain_words(text)
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        for search in self.searches:
            sizes = self.sizes(words, search)
            first, second = np.argsort(sizes, kind="stable")[:2].tolist()
            margin = 1 - sizes[first] / sizes[second]
            if margin >= NARROW:
                break
        return self.languages[first], margin


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_margin: float = MIN_MARGIN,
    short_bytes: int = SHORT_BYTES,
) -> DataFrame:
    """One row per document: its id, ``lang``, ``score`` and ``rejected``.

    ``score`` is 1 - exp(-margin / 0.05) for the margin by which the smallest
    encoding beats the next, so 0 is a tie; ``rejected`` marks margins under
    ``min_margin``. Texts of up to ``short_bytes`` of letters are encoded in
    four orders of their words, whose sizes add up. Texts that are null or have no letter are ``und``, rejected
    with score 0, as is everything where nothing was learned. Only the text is
    looked at, whole; repeated rows and null ids pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        compressors = Compressors(shared.value, short_bytes)
        for batch in batches:
            found = [compressors.verdict(text.as_py() or "") for text in batch.column(1)]
            margins = np.array([margin for _, margin in found], float)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array(1 - np.exp(-margins / 0.05)),
                    pa.array(margins < min_margin),
                ],
                [id_col, "lang", "score", "rejected"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, lang string, score double, rejected boolean"
    )
