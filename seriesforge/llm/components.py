"""Connected components as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import stored


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(id, label): for every id of an edge (a, b), the smallest id it is connected with.

    Large-star and small-star steps take turns: first every larger neighbour of a node, then every smaller one, is
    tied to the smallest id around that node. Each step is a minimum per node and a join, so no neighbourhood is
    gathered, and the number of edges never grows. The steps end when every component is a star around its smallest
    id; the number of rounds follows the logarithm of the largest component. Each round is written to the shared
    folder, and the driver sees two numbers of it.
    """
    current = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        around = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(around, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        current = stored(
            small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges"
        )
    centres = current.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(centres)
