"""Connected components by alternating star contractions, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.scale import materialise


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least node among u and its partners; a hot u is summed map-side first."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node of its component.

    Nodes are of any orderable type. Edges with a null end or both ends equal are ignored. Every
    round is written to the shared folder, so that lost executors repeat one round at most.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = materialise(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct())
    seen = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # partners above u go to the least partner of u
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where("u <> v").distinct())
        # u and its partners below go to the least of them
        small = _with_least(large)
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = materialise(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
