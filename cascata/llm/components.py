"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and an equi-join; nothing but two numbers per
round comes to the driver, and each round's edges are written to the shared
folder.  Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import written


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node of its component, for every node of an edge; long nodes, none null."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    before = _fingerprint(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = written(small, "edges")
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    # settled: every node hangs on its component's smallest node
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
