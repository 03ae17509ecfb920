"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (columns ``a``, ``b``); the label is one node of its component.

    Every node hooks on to its smallest neighbour, chains of hooks are shortened twice, and
    links between the remaining roots go to the next turn, so that the table shrinks by half
    at least. Rows are pairs of identifiers; hot nodes are pre-aggregated before the shuffle.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        hooks = stored(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("root")), "hooks")
        for _ in range(2):
            further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hooks = hooks.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        hooks = stored(hooks, "hooks")
        if labels is None:
            labels = hooks.withColumnRenamed("root", "label")
        else:
            onward = hooks.withColumnsRenamed({"node": "label", "root": "next"})
            labels = labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        labels = stored(labels, "labels")
        a = hooks.withColumnsRenamed({"node": "a", "root": "root_a"})
        b = hooks.withColumnsRenamed({"node": "b", "root": "root_b"})
        links = links.join(a, "a").join(b, "b").where("root_a <> root_b")
        links = stored(links.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))
