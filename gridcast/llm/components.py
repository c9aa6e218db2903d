"""Connected components of a graph given as edges, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.stored import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label for each node with an edge; the label is the least node of its component.

    Every round takes the least label among the neighbours, then the label of the label, which halves what is left of
    a path. Nothing is collected but the number of labels that changed. A node with very many edges is one key of a
    sort-merge join, which adaptive execution splits; the least label is aggregated before the shuffle.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
    both = checkpointed(both.where("node <> other").distinct())
    labels = checkpointed(both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "other", "label": "l"}), "other").groupBy("node").agg(F.min("l").alias("l"))
        least = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        least = checkpointed(least)
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = checkpointed(least.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("far", "label")).alias("label")))
        labels = step.select("node", "label")
        if step.where("label <> was").isEmpty():
            return labels
