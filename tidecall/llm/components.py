"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label``: the smallest node of each component, for the nodes of ``links`` (``a, b``).

    Each round takes the smallest label among a node's neighbours and then the label of that
    label, so paths halve. It ends when no label changes. Every round is written, so a lost
    executor costs one round; what is aggregated per node is combined before the shuffle.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = scratch.write(both.where("a != b").distinct(), "edges")
    labels = scratch.write(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("label"), F.lit(True).alias("changed")
        ),
        "labels",
    )
    while not labels.where("changed").isEmpty():
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = scratch.write(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "hooked",
        )
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        before = labels
        labels = scratch.write(
            hooked.join(jump, "label").select(
                "node", F.least("label", "further").alias("label"), (F.least("label", "further") != F.col("old")).alias("changed")
            ),
            "labels",
        )
        scratch.drop(before, hooked)
    return labels.select("node", "label")
