"""The dealt operators over their whole tables, with the digest columns of their contracts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squadweave.llm import (
    bpe,
    centroid_clustering,
    chat_format,
    collocations,
    decontaminate,
    html_extract,
    language_id,
    line_dedup,
    near_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    suffix_tree_lm,
)
from squadweave.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op3_decontamination(spark, sf_dir):
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_suffix_tree_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tree, counts = suffix_tree_lm.train(docs.filter(suffix_tree_lm.in_training(F.col("doc_id"))).select("text"))
    scored = suffix_tree_lm.score(docs, tree, counts)
    return scored.select(
        "doc_id",
        (~suffix_tree_lm.in_training(F.col("doc_id"))).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tree.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op5_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.statistics(table(spark, sf_dir, "documents"))


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    training = language_id.in_training(F.col("doc_id"))
    found = language_id.identify(docs, language_id.learn(docs.filter(training)))
    return found.select(
        "doc_id", (~language_id.in_training(F.col("doc_id"))).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected"
    )


def op8_html_extract(spark, sf_dir):
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_line_dedup(spark, sf_dir):
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "lines_cut", "text")


def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs, model)
    toxic = F.col("toxic") > 0.5
    return scored.select(
        "doc_id",
        F.col("quality").alias("p_quality"),
        F.col("toxic").alias("p_toxic"),
        toxic.alias("toxic"),
        ((F.col("quality") > 0.5) & ~toxic).alias("kept"),
    )


def op11_chat_format(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    both = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    added = spark.createDataFrame(both, "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.formatted(conversations.select(added.columns).unionByName(added)))


def op12_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark, sf_dir):
    return centroid_clustering.report(*centroid_clustering.cluster(table(spark, sf_dir, "embeddings")))


QUERIES = {
    query.__name__: query
    for query in (
        op1_byte_bpe,
        op2_secret_scan,
        op3_decontamination,
        op4_suffix_tree_lm,
        op5_near_dedup,
        op6_quality_rules,
        op7_language_id,
        op8_html_extract,
        op9_line_dedup,
        op10_quality_classifier,
        op11_chat_format,
        op12_collocations,
        op13_centroid_clustering,
    )
}
