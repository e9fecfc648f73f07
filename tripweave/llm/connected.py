"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.sinks.files import store


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (columns ``a``, ``b``): the component's least node.

    Each round takes the least label among a node and its neighbours and then the label of that
    label, and is written to the shared folder. Neighbours are combined before they are
    shuffled, so a node with very many edges is no hot group.
    """
    both = store(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where(F.col("a") != F.col("b")).distinct(), "edges")
    labels = store(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near")))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = labels.select(F.col("node").alias("_above"), F.col("root").alias("_top"))
        following = store(
            hooked.join(above, hooked["root"] == above["_above"], "left")
            .select("node", F.least("root", F.coalesce("_top", "root")).alias("root"), "old"), "labels")
        changed = not following.where(F.col("root") != F.col("old")).isEmpty()
        labels = following.select("node", "root")
        if not changed:
            return labels
