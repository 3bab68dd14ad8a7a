"""Connected components of links, as Spark joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillgauge.session import discard, materialised


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``): the smallest node reachable from each node of ``links`` (``a``, ``b``), itself included.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then
    its smaller neighbours and itself to that one. Stars replace chains, so the number of rounds grows with the logarithm of
    the longest path. A node with very many neighbours is summed up by partial aggregates; no list of neighbours
    is built. Every round is written to the shared folder. Links from a node to itself are allowed; no links give
    no rows.
    """
    edges = materialised(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    mark = _mark(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours go to the smallest node around
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        # smaller neighbours too, and the node itself
        small = large.join(smallest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        last, edges = edges, materialised(small.where("u != v").distinct(), "links")
        discard(last)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and two sums of hashes."""
    hashes = F.xxhash64("u", "v").cast("decimal(38,0)"), F.hash("v", "u").cast("bigint")
    return tuple(edges.agg(F.count(F.lit(1)), *map(F.sum, hashes)).first())
