"""Connected components as Spark jobs: large-star and small-star rounds on written tables.

Each round hangs nodes on the smallest node they see; the edges never grow in number. All
steps are minima (combined before the shuffle) and joins of the edges with one row per
node, which adaptive execution splits at a hub. A round is written, so lineage stays short
and a lost executor costs one round. Nothing but two sums per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.session import settled


def _sums(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def connected_components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component) for every node that has an edge to another node.

    The component is its smallest node. Edges may repeat, run both ways or be loops; an
    edge with a null end is none.
    """
    a, b = F.col(first), F.col(second)
    pairs = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    pairs = settled(pairs.distinct(), "edges")
    sums = _sums(pairs)
    while sums[0]:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = settled(moved.union(least).distinct(), "edges")
        after_sums = _sums(after)
        if after_sums == sums:
            break
        pairs, sums = after, after_sums
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(pairs.select("b", "b")).distinct()
