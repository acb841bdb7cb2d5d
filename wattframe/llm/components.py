"""Connected components of links between documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

_MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """The component of each node that a link (a, b; numbers) touches: node and component, its smallest node.

    In each round a node takes the smallest label of its neighbours, then the
    label that this label's node has, so labels travel in leaps. Messages are
    combined before they are shuffled. The driver learns only whether labels
    changed. No links give an empty table.
    """
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(edges.where("a <> b").distinct(), "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("least"))
    labels = written(labels.select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    for _ in range(_MOST_ROUNDS):
        told = edges.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "component")
        # a label's own node also hears of a smaller label
        near = labels.unionByName(told).groupBy("node").agg(F.min("component").alias("near"))
        heard = near.join(labels, "node").where("near < component").select(F.col("component").alias("node"), "near")
        near = near.unionByName(heard).groupBy("node").agg(F.min("near").alias("near"))
        leap = near.select(F.col("node").alias("near"), F.col("near").alias("further"))
        new = near.join(leap, "near", "left").select("node", F.least("near", "further").alias("component"))
        new = written(new, "labels")
        changed = new.join(labels.withColumnRenamed("component", "old"), "node").where("component <> old")
        if changed.isEmpty():
            return new
        labels = new
    raise RuntimeError("the components did not settle")
