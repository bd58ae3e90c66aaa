"""Questions over node and edge tables: chains of joins, counts and shared neighbours."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.session import bucket, buckets_of
from squadweave.sources.tables import present, top_k

# Neighbours up to which a shared node lists its pairs itself.
LIGHT = 64

# Left nodes and shared nodes per side of a counting cell.
TILE = 1024
STRIP = 256


@dataclass(frozen=True)
class Hop:
    """One step of a path: an edge table and how its columns meet those reached so far."""

    edges: DataFrame
    on: dict[str, str]
    optional: bool = False


def expand(df: DataFrame, hop: Hop) -> DataFrame:
    """Rows with the columns of the edges they meet; an optional hop keeps rows that meet none."""
    inner = {edge: f"_hop_{edge}" for edge in hop.on.values()}
    edges = hop.edges.select(*[F.col(name).alias(inner.get(name, name)) for name in hop.edges.columns])
    met = [F.col(have) == F.col(inner[edge]) for have, edge in hop.on.items()]
    return df.join(edges, met, "left" if hop.optional else "inner").drop(*inner.values())


def path(start: DataFrame, hops: list[Hop]) -> DataFrame:
    for hop in hops:
        start = expand(start, hop)
    return start


def path_top_k(start: DataFrame, hops: list[Hop], order: list[Column], k: int, then: list[Hop]) -> DataFrame:
    """A path cut to its first ``k`` rows before the last hops are taken."""
    return path(top_k(path(start, hops), order, k), then)


def top_producers(edges: DataFrame, via: str, who: list[str], k: int) -> DataFrame:
    """The ``k`` nodes that the most distinct others lead to."""
    counted = present(edges.select(via, *who), [via, *who]).distinct().groupBy(via).agg(F.count(F.lit(1)).alias("n"))
    return top_k(counted, [F.desc("n"), F.asc(via)], k)


def transfer_counts(edges: DataFrame) -> DataFrame:
    """Number of transfers from team to team."""
    return edges.groupBy("from_team", "to_team").agg(F.count(F.lit(1)).alias("n"))


def count_by_path(start: DataFrame, hops: list[Hop], predicate: Column, group: str, who: list[str]) -> DataFrame:
    """Distinct ends of a path that meet a predicate, counted per ``group``."""
    ends = present(path(start, hops).filter(predicate).select(group, *who), [group, *who]).distinct()
    return ends.groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def shared_neighbors(edges: DataFrame, left: str, via: str, light: int = LIGHT, min_shared: int = 1) -> DataFrame:
    """Pairs of left nodes with the number of ``via`` nodes that both lead to, if it is at least ``min_shared``.

    A ``via`` node with few neighbours lists its pairs, and nodes with the
    same neighbours list them once. Busier nodes never do: their edges are cut
    into cells of two tiles of left nodes and a strip of ``via`` nodes, and
    each cell counts by a matrix product of bounded size.
    """
    links = present(edges.select(left, via), [left, via]).distinct()
    busy = links.groupBy(via).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > light).select(via)
    few = links.join(busy, via, "left_anti")
    many = links.join(busy, via, "left_semi")
    counted = _listed_pairs(few, left, via).unionByName(_tiled_pairs(many, left, via))
    shared = counted.groupBy(f"{left}_a", f"{left}_b").agg(F.sum("n").alias("shared"))
    return shared.filter(F.col("shared") >= min_shared) if min_shared > 1 else shared


def _listed_pairs(links: DataFrame, left: str, via: str) -> DataFrame:
    same = (
        links.groupBy(via)
        .agg(F.array_sort(F.collect_list(left)).alias("members"))
        .filter(F.size("members") > 1)
        .groupBy("members")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    firsts = same.select("n", "members", F.posexplode("members").alias("at", f"{left}_a"))
    return firsts.select(
        f"{left}_a",
        F.explode(F.slice("members", F.col("at") + 2, F.size("members"))).alias(f"{left}_b"),
        "n",
    )


def _tiled_pairs(links: DataFrame, left: str, via: str) -> DataFrame:
    tiles = buckets_of(links.select(left).distinct(), TILE)
    strips = buckets_of(links.select(via).distinct(), STRIP)
    placed = links.select(
        F.col(left).alias("node"),
        F.col(via).alias("via"),
        bucket(F.col(left), tiles).alias("tile"),
        bucket(F.col(via), strips).alias("strip"),
    )
    # An edge goes only to those tiles that have nodes in its strip.
    met = placed.select("strip", F.col("tile").alias("other")).distinct()
    placed = placed.join(met, "strip").withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})
    kind = links.schema[left].dataType.simpleString()

    def count(cell: pd.DataFrame) -> pd.DataFrame:
        i, j = cell["i"].iat[0], cell["j"].iat[0]
        strip_codes, strip_nodes = pd.factorize(cell["via"])
        sides = []
        for tile in (i, j):
            here = (cell["tile"] == tile).to_numpy()
            codes, nodes = pd.factorize(cell["node"][here])
            links_of = np.zeros((len(nodes), len(strip_nodes)), dtype=np.float32)
            links_of[codes, strip_codes[here]] = 1
            sides.append((np.asarray(nodes, dtype=object), links_of))
        (rows, row_links), (columns, column_links) = sides
        shared = row_links @ column_links.T
        at_row, at_column = np.nonzero(shared)
        a, b = rows[at_row], columns[at_column]
        n = shared[at_row, at_column].astype(np.int64)
        if i == j:
            once = np.array(a < b, dtype=bool)
            a, b, n = a[once], b[once], n[once]
        swap = np.array(a > b, dtype=bool)
        return pd.DataFrame({"a": np.where(swap, b, a), "b": np.where(swap, a, b), "n": n})

    return (
        placed.groupBy("i", "j", "strip")
        .applyInPandas(count, f"a {kind}, b {kind}, n long")
        .toDF(f"{left}_a", f"{left}_b", "n")
    )
