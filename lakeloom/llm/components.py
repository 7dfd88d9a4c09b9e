"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import settle


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v); the root is the smallest node reached.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest
    node it sees. Rounds grow with the logarithm of a component's size. Minima are aggregated
    before they are joined back, so that a hub's neighbours are never gathered; each round is
    written to the shared folder.
    """
    edges = settle(
        links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
            .filter("u != v")
            .distinct()
        )
        large = settle(large, "large-star")
        small = large.join(_least(large), "u")
        edges = settle(
            small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(small.select("u", F.col("least").alias("v")))
            .filter("u != v")
            .distinct(),
            "small-star",
        )
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
