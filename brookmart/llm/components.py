"""Connected components of a graph of links between integers, by least label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the component's least node.

    Each round takes the least label among the neighbours and then the label's label, so rounds grow with the logarithm of
    the longest chain. Labels are written each round; a hot node is a skewed side of a plain join, which Spark splits.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        seen = stored(labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "labels")
        up = seen.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        jumped = stored(seen.join(up, F.col("root") == F.col("up")).select("node", "old", F.col("up_root").alias("root")), "labels")
        labels = jumped.select("node", "root")
        if not jumped.where("root != old").limit(1).count():
            return labels
