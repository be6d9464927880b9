"""Connected components of a graph that is only ever held as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codedframes.llm.common import drop_saved, saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each end of the edges `a`, `b` (long): root is the smallest node of the component.

    Large-star and small-star steps alternate until only stars are left: no node is the higher end of two edges, or a
    higher and a lower end. Each state is a table in the shared folder. The minima are written before they are joined, so
    both inputs of a join are plain shuffles, whose hot keys (hubs) adaptive execution can split; they also tell whether
    stars are all that is left. Null ends and loops are left out; an empty graph gives no rows.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    while True:
        ends = now.selectExpr("high AS node", "low AS to", "1 AS above", "0 AS below").union(now.selectExpr("low", "high", "0", "1"))
        smallest = saved(ends.groupBy("node").agg(
            F.least(F.min("to"), F.col("node")).alias("least"), (F.sum("above") + F.max("below") > 1).alias("open")))
        if smallest.where("open").isEmpty():
            return smallest.select("node", F.col("least").alias("root"))
        large = saved(now.join(smallest, now.low == smallest.node).select("high", F.col("least").alias("low")).distinct())
        smallest_below = saved(large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least")))
        moved = large.join(smallest_below, large.high == smallest_below.node).where("low <> least").select("low", "least")
        after = saved(smallest_below.select(F.col("node").alias("high"), F.col("least").alias("low")).union(moved).distinct())
        for old in (now, smallest, large, smallest_below):
            drop_saved(old)
        now = after
