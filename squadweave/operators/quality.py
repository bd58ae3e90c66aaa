"""Profiles and data quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadweave.operators.graph import match


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1").orderBy(F.desc("n"), *keys)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Violations of a key: ``duplicate`` and ``null key``. No rows means the key holds."""
    has_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn(
        "problem", F.when(has_null, "null key").when(F.col("n") > 1, "duplicate")
    ).filter(F.col("problem").isNotNull())


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if a key does not hold."""
    found = assert_unique(df, keys).take(3)
    if found:
        raise ValueError(f"{what}: key {keys} does not hold, such as {found}")


def unmatched_report(rows: DataFrame, nodes: DataFrame, on: dict[str, str]) -> DataFrame:
    """Key values that meet no node, with the number of rows that are lost to each."""
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    keys = nodes.select(*[F.col(node).alias(f"_node_{at}") for at, node in enumerate(on.values())])
    met = [F.col(row) == F.col(f"_node_{at}") for at, row in enumerate(on)]
    return counted.join(keys, met, "left_anti")


def matched_share(rows: DataFrame, nodes: DataFrame, on: dict[str, str]) -> DataFrame:
    """How many rows there are and how many meet a node."""
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("rows"))
    return total.withColumn("matched", match(counted, nodes, on).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar())
