"""Connected components of a link table, as joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwell.session import materialize


def _step(links: DataFrame, large: bool) -> DataFrame:
    """One star step: hang the neighbours of each node on its smallest neighbour.

    The large step moves larger neighbours, the small step smaller ones and the node.
    The smallest neighbours are written out, so both sides of the join are plain
    tables and a node with very many links is split by the adaptive planner.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    lowest = materialize(both.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    lowest = lowest.withColumn("low", F.least("a", "low"))
    if large:
        moved = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = both.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(lowest.select("a", F.col("low").alias("b")))
    ordered = moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return materialize(ordered.distinct(), "links")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b); the component is its smallest node.

    Alternates large and small star steps until nothing changes, which takes about as
    many rounds as the logarithm of the longest chain.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    before = None
    while before != (before := _state(links)):
        links = _step(_step(links, large=True), large=False)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
