"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pingzones.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.least("high", F.min("low")).alias("least"))
    return both.join(least, "high").filter("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").filter("low != least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.select("high", F.col("least").alias("low")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of one type) but the roots.

    The root is the smallest node of the component.  A round shortens every
    path by a large part, so rounds grow as the logarithm of the longest chain.
    The degree of a node is never gathered: neighbours are reduced by ``min``.
    Links of a node to itself, repeated ones and nulls change nothing.
    """
    a, b = links.columns
    edges = stored(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .filter("high > low and low is not null")
        .distinct(),
        "components",
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
        state = now
        large = _large_star(edges).distinct()
        edges = stored(_small_star(large).distinct(), "components")
