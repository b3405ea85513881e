"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.common import stash


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``links`` (a, b); the root is the least node of a component.

    Each round takes the least label among a node's neighbours and then the label of that
    label; it ends when no label falls.  Labels fall in every other round, so there is no
    bound on rounds to run into.  Hot nodes only meet map-side minima and joins that AQE splits.
    """
    both = stash(links.select(F.col("a"), F.col("b")).unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .filter("a <> b").distinct(), "links")
    labels = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("near")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near")))
        least = labels.join(near, "node", "left").select(
            "node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("jump"))
        moved = stash(least.join(jump, "next", "left").select(
            "node", "old", F.least("next", F.coalesce("jump", "next")).alias("root")), "labels")
        labels = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return labels
