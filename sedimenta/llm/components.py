"""Connected components by alternating large-star and small-star.

Every round hooks the neighbours of each node to the smallest node in reach: large-star the
larger neighbours, small-star the smaller ones and the node itself. The edges end as stars
around the smallest node of each component. Minima are aggregated and joined back, so the
neighbours of a hub are never gathered in one task, and a round's edges are written to the
shared folder, where the next round starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) in either direction: larger neighbours of u go to the smallest in reach."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    low = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_low"))
    return (
        both.join(low, F.col("u") == F.col("_u"))
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "_low").alias("v"))
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with v < u: u and its smaller neighbours go to the smallest of them."""
    low = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_low"))
    hooked = edges.join(low, F.col("u") == F.col("_u")).where(F.col("v") != F.col("_low"))
    return low.select(F.col("_u").alias("u"), F.col("_low").alias("v")).union(
        hooked.select(F.col("v").alias("u"), F.col("_low").alias("v"))
    )


def connected(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node that has an edge.

    Edges have columns u and v of one ordered type; loops and repeated edges do no harm. The
    root is its own node too.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = stored(edges.distinct(), "edges")
    state = None
    while True:
        edges = stored(small_star(large_star(edges)).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
