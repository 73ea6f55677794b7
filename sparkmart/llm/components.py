"""Connected components of a table of links, by joins and aggregates only.

Each round lowers the label of a node to the least label among its neighbours, hooks the node that was its label
to the same, and replaces labels by their labels. The number of rounds is about the logarithm of the longest path. A node with very many
links is no hot group: least labels are combined before the shuffle, and the joins read written tables, so that Spark can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import store


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) from links (a, b): label is the least node reachable. Only nodes with links are listed."""
    links = store(links.select("a", "b").filter("a <> b").distinct())
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = store(nodes.withColumn("label", F.col("node")))
    while True:
        of = lambda side, name: labels.select(F.col("node").alias(side), F.col("label").alias(name))
        ends = store(links.join(of("a", "_a"), "a").join(of("b", "_b"), "b").select("a", "b", "_a", "_b").filter("_a <> _b"))
        if ends.isEmpty():
            return labels
        lower = lambda node, label: ends.select(F.col(node).alias("node"), F.col(label).alias("_new"))
        offers = lower("a", "_b").union(lower("b", "_a")).union(lower("_a", "_b")).union(lower("_b", "_a"))
        best = store(offers.filter("_new < node").groupBy("node").agg(F.min("_new").alias("_new")))
        lowered = store(labels.join(best, "node", "left").select("node", F.least("label", F.coalesce("_new", "label")).alias("label")))
        above = lowered.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        labels = store(lowered.join(above, "label", "left").select("node", F.coalesce("_next", "label").alias("label")))
