"""Connected components of a large edge table by alternating stars.

Every pass is two aggregations and joins; no adjacency is gathered, edges never reach the driver,
and each pass is written to the shared folder so that a lost executor costs one pass at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str, max_passes: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") > F.col("v")).distinct()
    last = None
    for _ in range(max_passes):
        e = saved(_small_star(_large_star(e)), "components")
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
