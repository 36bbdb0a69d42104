"""Connected components of a table of links, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the links (a, b): the component is its smallest node.

    Each round gives a node the smallest label of its neighbours and then that label's own label, so labels travel
    twice as far with every round. A round is written to the shared folder; only a count of changes comes back.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels"
    )
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        least = labels.join(near, "node").select("node", F.least("component", "near").alias("via"), F.col("component").alias("old"))
        up = labels.select(F.col("node").alias("via"), F.col("component").alias("above"))
        moved = stored(
            least.join(up, "via").select("node", F.least("via", "above").alias("component"), "old"), "labels"
        )
        labels = moved.select("node", "component")
        if moved.where("component <> old").limit(1).count() == 0:
            return labels
