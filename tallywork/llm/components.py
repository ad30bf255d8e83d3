"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import written


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node in a link.

    ``links`` has columns ``a`` and ``b``. Each round gives every node the
    smallest label among its own and its neighbours' and then the label of its
    label, so chains shorten by half or more. Labels are aggregated, never
    collected, so a node with many links costs one row per task. Every round
    is a table in the shared folder. The driver sees one number per round.
    """
    both = links.select("a", "b").where(F.col("a") != F.col("b"))
    both = both.union(both.select(F.col("b"), F.col("a")))
    links = written(both.distinct(), "links")
    labels = links.groupBy("a").agg(F.min("b").alias("b"))
    labels = written(labels.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        low = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        # Hooking: what was the label of a node takes over the smaller label too.
        hooked = low.groupBy(F.col("old").alias("hook")).agg(F.min("root").alias("hooked"))
        low = low.join(hooked, low["node"] == hooked["hook"], "left").select(
            "node", "old", F.least("root", "hooked").alias("root")
        )
        low = written(low, "labels_hooked")
        up = low.select(F.col("node").alias("at"), F.col("root").alias("up"))
        jumped = low.join(up, low["root"] == up["at"], "left").select(
            "node", "old", F.least("root", "up").alias("root")
        )
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "root")
        if not jumped.where(F.col("old") != F.col("root")).limit(1).count():
            return labels
