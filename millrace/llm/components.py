"""Connected components of an edge list, by smallest label, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node it is connected with.

    Labels spread to neighbours and then jump to their label's label, so long chains take few rounds.
    An empty edge list gives an empty result.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        roots = labels.select(F.col("node").alias("to"), F.col("label").alias("root"))
        after = spread.join(roots, "to").select("node", F.least("to", "root").alias("label"), "was")
        step = saved(after, "labels")
        labels = step.select("node", "label")
        if step.where("label <> was").isEmpty():
            return labels
