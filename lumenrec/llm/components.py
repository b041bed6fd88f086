"""Connected components over a table of links, in rounds that each end in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenrec.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b bigint) → (node, label): label is the smallest node reachable.

    Each round gives a node the smallest label among its neighbours and then follows labels once
    (a label is itself a node), so the number of rounds is about the logarithm of the longest path.
    Minimum per node is combined before the shuffle; the label tables are written and read again,
    so both sides of a join are plain exchanges, which Spark may split when a node is hot.
    Nodes without links are not listed.
    """
    pairs = links.select("a", "b").where("a <> b")
    both = materialize(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("low"))
        lower = labels.join(near, labels.node == near.a, "left").select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label")
        )
        lower = materialize(lower, "lower")
        up = lower.select(F.col("node").alias("up"), F.col("label").alias("higher"))
        jumped = lower.join(up, lower.label == up.up, "left").select(
            "node", F.least("label", "higher").alias("label"), (F.least("label", "higher") < F.col("old")).alias("moved")
        )
        stepped = materialize(jumped, "labels")
        labels = stepped.select("node", "label")
        if stepped.where("moved").isEmpty():
            return labels
