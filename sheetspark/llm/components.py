"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import stored


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node it can reach) for every node of a link.

    ``links`` has bigint columns ``a`` and ``b``.  Nodes hook onto the smallest neighbour they
    know of, by turns over larger and over smaller neighbours, until every component is a star
    around its root.  A turn combines the neighbours of a node before they are shuffled, however
    many there are, and writes its links as a table, so that the lineage stays short.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        f"{label}-links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(_least(both), f"{label}-least")
        # Larger neighbours hook onto the least neighbour.
        hooked = _hook(both.where("b > a"), least).select(
            F.col("b").alias("a"), F.col("least").alias("b")
        )
        hooked = stored(hooked.where("a != b").distinct(), f"{label}-hooked")
        least = stored(_least(hooked), f"{label}-least")
        # Smaller neighbours, and the node itself, hook onto the least of them.
        own = least.select("a", F.col("least").alias("b"))
        moved = _hook(hooked, least).select(F.col("b").alias("a"), F.col("least").alias("b"))
        following = stored(
            own.unionByName(moved).where("a != b").distinct(), f"{label}-links"
        )
        counts = following.agg(F.count("*"), F.countDistinct("a")).first()
        inner = following.join(following.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        edges = following
        if counts[0] == counts[1] and inner.isEmpty():
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    selves = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stored(roots.unionByName(selves), f"{label}-roots")


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))


def _hook(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "a")
