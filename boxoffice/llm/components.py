"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), where root is the smallest id of
    its component. Large-star and small-star steps alternate until nothing changes:
    each rewires nodes to their smallest neighbour, so a hub's edges are spread by the
    aggregation's map side and no group is ever held in memory. Every round is written
    to the shared folder. The number of rounds grows with the logarithm of the
    longest path."""
    now = common.written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .where("u != v").distinct(), "edges")
    last = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct())
        now = common.written(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.countDistinct("u")).first()
        if state == last or state[0] == 0:
            break
        last = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v"), F.col("v"))).distinct()
