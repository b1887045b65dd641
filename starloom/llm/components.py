"""Connected components of links, by hooking every component to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import saved


def merge_components(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after linked nodes (a, b) have come to share the smallest label.

    Each turn contracts the links to labels and hooks a label to the smallest it is linked to.
    A star is done after two turns. Only links between different labels live on, and a label
    with many links is reduced to its minimum before the shuffle.
    """
    while True:
        named = (
            links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b")
            .where("label_a <> label_b")
        )
        links = saved(spark, named.select("a", "b", "label_a", "label_b"), "open-links")
        high, low = F.greatest("label_a", "label_b"), F.least("label_a", "label_b")
        hooks = links.groupBy(high.alias("label")).agg(F.min(low).alias("to"))
        hooks = saved(spark, hooks, "hooks")
        if hooks.isEmpty():
            return labels
        links = links.select("a", "b")
        labels = saved(
            spark,
            labels.join(hooks, "label", "left").select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )
