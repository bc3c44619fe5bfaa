"""Connected components by alternating large and small stars.

Each round is joins and grouped minima, so a node with very many links is
spread by partial aggregation and by splitting its join partition; nothing is
collected. A round ends in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.frames import written


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest
    of them. Links go from the larger node to the smaller."""
    least = _least(links)
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node of the component of every node with a
    link. ``edges`` has two columns of one ordered type; order, repeats, loops
    and nulls don't matter. Without links, an empty table."""
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    links, before = written(links.distinct(), name), None
    while True:
        # Stars are what both steps leave as they are.
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or state[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        links = written(_small(_large(links).distinct()).distinct(), name)
