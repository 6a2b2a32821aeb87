"""Connected components of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_analytics.llm.shared import cut


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of `links` (a, b): label is the least node reachable.

    Each round takes the least label among a node and its neighbours and then the label of that
    label, so a chain of n links ends after about log n rounds. Labels are summed per task before each
    shuffle; a node with very many links is a skewed join that Spark splits. Rounds are cut by checkpoint().
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = cut(both)
    labels = cut(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        .select("node", F.least("node", "_least").alias("label"), F.lit(True).alias("_moved"))
    )
    while labels.filter("_moved").limit(1).count():
        known = labels.select("node", "label")
        near = both.join(known, both.b == known.node).groupBy("a").agg(F.min("label").alias("_near"))
        least = known.join(near, known.node == near.a).select(
            "node", F.least("label", "_near").alias("_to"), F.col("label").alias("_was")
        )
        jump = known.select(F.col("node").alias("_at"), F.col("label").alias("_over"))
        labels = cut(
            least.join(jump, least._to == jump._at)
            .select("node", F.least("_over", "_to").alias("label"), (F.least("_over", "_to") != F.col("_was")).alias("_moved"))
        )
    return labels.select("node", "label")
