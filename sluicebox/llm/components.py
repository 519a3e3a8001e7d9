"""Connected components of links by least labels, in rounds of joins over written tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.plans.workspace import Workspace


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """node, component (its least node) of every node of the links (left, right: bigint).

    A round takes each node to the least label among its neighbours and then to
    that label's own label, so the rounds grow with the logarithm of the longest
    chain.  Only the count of changed labels reaches the driver.
    """
    both = work.stage(links.select("left", "right").union(links.select("right", "left")).distinct(), f"{name}-links")
    labels = work.stage(both.groupBy("left").agg(F.least(F.first("left"), F.min("right")).alias("component"))
                        .withColumnRenamed("left", "node"), f"{name}-0")
    for k in range(1, 1000):
        near = (
            both.join(labels, F.col("right") == F.col("node")).groupBy("left").agg(F.min("component").alias("near"))
        )
        moved = labels.join(near, F.col("node") == F.col("left")).select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("next"))
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("above"))
        new = work.stage(
            moved.join(up, F.col("next") == F.col("up"), "left")
            .select("node", "was", F.least("next", F.coalesce("above", "next")).alias("component")), f"{name}-{k}")
        labels = new.select("node", "component")
        if new.where("component <> was").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
