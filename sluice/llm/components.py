"""Connected components of a graph of links, by smallest label with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import written


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in ``links`` (a, b); ``label`` is the smallest node that can be reached.

    In each round a node takes the smallest label next to it, and then its
    label's label, so that rounds grow with the logarithm of the longest way. Nothing
    is brought to the driver but whether there were changes; each round is stored.
    A node may have any number of links, and a label any number of nodes: rows of one
    key are streamed past the one label that they look up, and Spark splits large ones.
    A round is planned with four exchanges and no broadcast, each of which costs the driver a thread.
    """
    ways = [("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")]  # in both directions, and from each node to itself
    ends = links.select(F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ways])).alias("end"))
    both = written(ends.select("end.*").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "labels")
    while True:
        target = labels.select(F.col("node").alias("b"), "label").hint("merge")
        own = F.when(F.col("a") == F.col("b"), F.col("label"))
        near = both.join(target, "b").groupBy("a").agg(F.min("label").alias("new"), F.max(own).alias("label"))
        beyond = labels.select(F.col("node").alias("new"), F.col("label").alias("beyond")).hint("merge")
        jumped = near.join(beyond, "new").select(F.col("a").alias("node"), "label", F.least("new", "beyond").alias("new"))
        state = written(jumped, "labels")
        changed = not state.where(F.col("new") < F.col("label")).isEmpty()
        labels = state.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
