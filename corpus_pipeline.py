"""A training-data pipeline over ``documents``: quality rules, line dedup, near-dedup, decontamination, token ids.

Each stage takes what the one before it kept. All but the last return the
columns of ``documents``, with ``n_chars`` brought up to date where a text changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadweave.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from squadweave.llm.common import fresh, written


def same_columns(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``changed`` with the columns of ``docs``, and the length of its texts."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier one holds; a document of nothing else goes."""
    cut = line_dedup.deduplicated(docs)
    left = (F.col("lines_cut") == 0) | (F.btrim("text", F.lit(quality_rules.BLANKS)) != "")
    return same_columns(docs, cut.filter(left))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, null last, then by hashes of text and row.

    Rows are told apart by a key of their own, as an id may be null or stand for several rows.
    """
    key, row = fresh(docs, "_key", "_row")
    first = [F.isnull("doc_id").alias("absent"), F.col("doc_id").alias("id")]
    hashes = [F.xxhash64("text").alias("text"), F.xxhash64(*docs.columns).alias("all")]
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()))
    keyed = numbered.select("text", F.struct(*first, *hashes, F.col(row).alias("row")).alias(key))
    kept = near_dedup.near_duplicates(keyed, key).filter("kept").select(F.col(f"{key}.row").alias(row))
    return numbered.join(kept, row, "left_semi").select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of test items; one that is mostly such passages goes."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return same_columns(docs, decontaminate.decontaminated(docs, items))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of every text's token ids, and digests of the ids and of what they decode to; ``bpe.encode`` has the ids."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("byte_bpe", tokens),
]

# The cutting of passages out of texts and the token ids have no SQL form that DuckDB could run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
