"""Connected components by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the least node reachable.

    Each round takes the least label among the neighbours and then follows
    labels of labels. A node with very many edges is pre-aggregated before the
    shuffle on one side and split as a skewed join key on the other. Labels
    are cut to the shared folder each round, so a round can be computed again.
    """
    edges = edges.where("a <> b")
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("far"))
        new = cut(low.join(jump, "low").select("node", "component", F.least("low", "far").alias("new")))
        changed = new.where("new <> component").limit(1).count()
        labels = new.select("node", F.col("new").alias("component"))
        if not changed:
            return labels
