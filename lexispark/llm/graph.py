"""Connected components over a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.common import Scratch


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges(a, b) of longs -> (node, component), component = the smallest node that the links reach.

    Smallest-label propagation with pointer jumping: each round takes the least label among the neighbours and then the
    label of that label, so long chains halve.  Every round is written to the shared folder.  Nodes without a link don't
    appear.  Nulls are ignored; repeated links and self-links count once and not at all.
    """
    pairs = edges.where("a <> b").select("a", "b").distinct()
    both = scratch.table(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    label = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")))
    while True:
        least = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("component").alias("least"))
        lower = label.join(least, label["node"] == least["a"]).select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("component")
        )
        lower = scratch.table(lower)
        up = lower.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        jumped = scratch.table(
            lower.join(up, F.col("component") == F.col("_n"), "left").select(
                "node", "old", F.least("component", F.coalesce("_c", "component")).alias("component")
            )
        )
        scratch.drop(label, lower)
        label = jumped
        if label.where("component <> old").isEmpty():
            scratch.drop(both)
            return label.select("node", "component")
