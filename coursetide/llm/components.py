"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetide.llm.inputs import cut_lineage

#: Each round at least halves the paths that are left, so this is never reached.
MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for all nodes but the roots.

    ``links`` has the columns ``a`` and ``b`` of one orderable type; loops and nulls are left out,
    repeated links and either direction are fine, no links give no rows. A round moves every
    node's larger neighbours to its smallest one, then its smaller ones. Neighbours are never
    gathered: minima are combined before the shuffle and joined back, and that join can be split
    where one node has very many links. Rounds are cut by tables in the shared checkpoint folder.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(pairs.distinct())
    before = _digest(edges)
    for _ in range(MAX_ROUNDS):
        edges = cut_lineage(_small_star(_large_star(edges)))
        after = _digest(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError("components have not settled")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())
