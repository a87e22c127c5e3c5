"""Connected components of links between rows, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.staging import Staging


def component_labels(links: DataFrame, staging: Staging) -> DataFrame:
    """``links`` has columns a, b of any ordered type. Returns (node, label) of
    every linked node; label is the smallest node of its component.

    Every round takes the smallest label among the neighbours, then the label
    of that label, so labels travel in doubling steps. A round ends in a
    written table. A hot node is one map-side minimum per task, and the joins
    are plain equi-joins that adaptive execution splits.
    """
    both = staging.save(
        links.select("a", "b")
        .unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct(),
        "links",
    )
    labels = staging.save(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("low"))
        .select("node", F.least("node", "low").alias("label")),
        "labels",
    )
    while True:
        seen = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("low"))
        )
        near = labels.join(seen, labels["node"] == seen["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("near")
        )
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        found = near.join(jump, "near").select(
            "node", F.least("near", "far").alias("label"), "old"
        )
        found = staging.save(found, "labels")
        labels = found.select("node", "label")
        if found.where("label <> old").isEmpty():
            return labels
