"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxstrata.session import discard, stage


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node reachable; only nodes with a link appear.

    Each round hangs every node's larger neighbours, then its smaller ones, under the
    smallest of them. Minima are combined before the shuffle and joined back, so a node
    with very many links never gathers them. A round is written to the shared folder and
    deleted when the one after the next is; their number grows with the logarithm of the longest path.
    """
    edges = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    before = earlier = None
    while True:
        state = _fingerprint(edges)
        if state == before and edges.exceptAll(earlier).isEmpty() and earlier.exceptAll(edges).isEmpty():
            discard(earlier)
            break
        if earlier is not None:
            discard(earlier)
        before, earlier = state, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("x"), "m", "u")
        edges = stage(
            small.select(F.col("x").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct(),
            "stars",
        )
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = leaves.select(F.col("root").alias("node"), "root").distinct()
    return leaves.unionByName(roots)
