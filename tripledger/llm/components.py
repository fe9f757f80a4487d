"""Connected components of a link table, by smallest labels with shortcuts, without hot tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import join_counted, stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): every node of ``links`` (a, b) with the smallest node reachable from it.

    Each round takes the smallest label among the neighbours, then the label's own label. The number
    of rounds grows with the logarithm of the longest chain. Messages are reduced in each task, and
    a node with a large share of the links meets a broadcast list, so a hub is no load.
    """
    edges = stored(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                   .union(links.select("b", "a")).distinct(), "links")
    degrees = stored(edges.groupBy("node").agg(
        F.count("*").alias("degree"), F.least(F.col("node"), F.min("other")).alias("label")),
        "degrees")
    sizes = degrees.agg(F.sum("degree"), F.count("*")).first()
    total, nodes = sizes[0] or 0, sizes[1]
    labels = degrees
    while True:
        sent = (join_counted(edges, labels, "node", "degree", total, "inner")
                .groupBy(F.col("other").alias("node")).agg(F.min("label").alias("near")))
        nearer = stored(labels.join(sent, "node").select(
            "node", "degree", F.col("label").alias("before"),
            F.least("label", "near").alias("label")), "labels")
        # The label's own label: a label shared by many nodes is looked up as a counted group.
        shared = nearer.groupBy("label").agg(F.count("*").alias("n"))
        roots = nearer.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = stored(
            join_counted(nearer, shared.join(roots, "label"), "label", "n", nodes, "inner")
            .select("node", "degree", "before", F.col("root").alias("label")), "labels")
        labels = jumped.drop("before")
        if jumped.where("before <> label").isEmpty():
            return labels.select("node", "label")
