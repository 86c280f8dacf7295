"""Connected components by alternating large-star and small-star steps.

Each round replaces links by links to the smallest neighbour, so long chains shorten
geometrically.  Links stay distributed; a round's result is written to the shared
checkpoint folder, and only its row count and checksum reach the driver.  Minima are
combined before the shuffle, and the joins on a hub are ordinary shuffle joins whose
skewed parts Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links(a, b)`` of longs to ``(node, root)``; root is the smallest node of the component.
    Nodes without links are absent; loops and repeated links do no harm."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        edges = materialize(_small_star(_large_star(edges)), "links")
        state = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
