"""Connected components of a table of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.sources import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node of its component.

    Each round takes the smallest label among the neighbours, then the label of that label, and
    writes the labels down; chains shorten by half at least.  Links and labels stay tables: only the
    number of labels that changed comes back.  The labels table is read from files, so that both
    sides of each join are plain scans and a node with very many links is split.
    """
    both = materialize(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .filter("u <> v")
        .distinct(),
        label="links",
    )
    labels = materialize(
        both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("label")),
        label="labels",
    )
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("label").alias("near"))
        closer = materialize(
            labels.join(near, F.col("node") == F.col("u")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            label="labels",
        )
        jump = closer.select(F.col("node").alias("at"), F.col("label").alias("beyond"))
        labels = materialize(
            closer.join(jump, F.col("label") == F.col("at")).select("node", F.least("label", "beyond").alias("label"), "old"),
            label="labels",
        )
        if labels.filter("label <> old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
