"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): every node of ``edges`` (a long, b long) with the
    smallest node that it can reach.

    Alternating large and small stars; each pass is aggregates and joins on a
    node, whose hot keys adaptive execution splits, and ends in a written table.
    Ends when only stars are left; the passes grow with the logarithm of the
    number of nodes.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # stars: no node has two parents, and no parent has one
        ends = now.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("k")), F.struct(F.col("v").alias("node"), F.lit(0).alias("k")))).alias("e")).select("e.*")
        if ends.groupBy("node").agg(F.sum("k").alias("up"), F.count_if(F.col("k") == 0).alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
