"""Connected components of an undirected edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.skew import salted_join
from stratiform.session import cut_lineage


def connected_components(nodes: DataFrame, edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``(node, component)`` where the component is the lowest node name in it.

    Every round takes the lowest label among the neighbours and then follows labels one
    step further (pointer jumping), so long chains shrink geometrically. Rounds are
    checkpointed, or kept by ``cut``. Many nodes share a label towards the end, hence the salted lookup.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.select("node", F.col("node").alias("component")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        stepped = labels.join(seen.withColumnRenamed("a", "node"), "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("component")
        )
        stepped = cut_lineage(stepped)
        roots = stepped.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = cut(
            salted_join(stepped, roots, ["component"], F.col("node"), "left").select(
                "node", "old", F.least("component", F.coalesce("next", "component")).alias("component")
            )
        )
        changed = jumped.filter(F.col("component") != F.col("old")).limit(1).count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
