"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import discard, staged


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node.

    Each round hangs the neighbours of a node on the smallest of them, by a join with per-node
    minima, so no neighbour list is ever gathered; the number of rounds grows with the logarithm
    of the longest path. Each round is a written table, and so is the result.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_minimum(both), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        hung = staged(large.where("a != b").distinct(), "large-star")
        discard(edges)
        edges = hung
        low = _minimum(edges)
        small = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.select("a", F.col("low").alias("b")))
        hung = staged(
            small.where("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "small-star",
        )
        discard(edges)
        edges = hung
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    known = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
    table = staged(known, "components")
    discard(edges)
    return table
