"""Connected components by alternating large and small stars; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from matchloom.llm.common import Scratch

ROUNDS = 100


def connected_components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, component) of every node that has an edge; component is the least node in reach.

    edges: (a, b) of type long; loops and repeated rows do no harm, rows with a null are ignored.
    Each round writes one table, so a lost executor costs one round at most. The rounds are as
    many as the logarithm of the longest path.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.save(edges, f"{tag}-0")
    for step in range(1, ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first, so that the edges of a hub are dealt to several tasks when they meet it
        below = F.count_if(F.col("v") < F.col("u"))
        open_ = (below > 1) | (below > 0) & (F.max("v") > F.col("u"))  # of no star yet
        seen = Observation()
        least = both.groupBy("u").agg(F.min("v").alias("m"), open_.alias("open")).observe(seen, F.count_if("open").alias("open"))
        least = scratch.save(least.select("u", F.least("u", "m").alias("m")), f"{tag}-least-{step}")
        if not seen.get["open"]:
            scratch.drop(f"{tag}-least-{step}")
            break
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = large.join(small, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = scratch.save(stars.where("u <> v").distinct(), f"{tag}-{step}")
        scratch.drop(f"{tag}-{step - 1}", f"{tag}-least-{step}")
    else:
        raise RuntimeError(f"components have not settled in {ROUNDS} rounds")
    parents = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return parents.unionByName(roots)
