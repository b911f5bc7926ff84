"""Connected components of a table of links, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_table


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node in ``links`` (a, b); ``comp`` is the least node of its component.

    Each round takes the least label of a node's neighbours, then the label of
    that label, which halves long chains; every round is a written table.
    Empty links give an empty result.
    """
    both = shared_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "links", small=True)
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    label = shared_table(label.select("node", F.least("node", "m").alias("comp")), "labels", small=True)
    while True:
        near = (both.join(label.withColumnsRenamed({"node": "b", "comp": "cb"}), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("cb").alias("m")))
        step = label.join(near, "node").select("node", F.col("comp").alias("old"),
                                               F.least("comp", "m").alias("comp"))
        hop = label.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        step = step.join(hop, "comp", "left").select("node", "old", F.coalesce(F.least("comp", "up"), "comp").alias("comp"))
        step = shared_table(step, "labels", small=True)
        label = step.select("node", "comp")
        if step.filter("old <> comp").isEmpty():
            return label
