"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, most: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b), both long and not
    null; label is the smallest node of its component.

    Each round takes the smallest label among a node and its neighbours and
    then the label of that label, so the reach doubles. Every round's labels
    are a written table. The minimum is taken map-side first; joins are plain
    equi-joins of written tables, which AQE can split on a hot node.
    """
    both = scratch.stage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = scratch.stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    for _ in range(most):
        known = labels.withColumnRenamed("node", "b").withColumnRenamed("label", "of_b")
        near = both.join(known, "b").select(F.col("a").alias("node"), F.col("of_b").alias("label"))
        least = scratch.stage(labels.union(near).groupBy("node").agg(F.min("label").alias("label")), "least")
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = scratch.stage(least.join(jump, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels")
        moved = new.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count()
        scratch.drop(labels, least)
        labels = new
        if not moved:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    scratch.drop(both)
    return labels
