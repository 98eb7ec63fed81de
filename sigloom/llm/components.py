"""Connected components of an undirected graph, by labels that spread and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.shared_storage import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): root is the smallest node that can be reached.

    Each round a node takes the smallest label of its neighbours, then the label of its label. The rounds needed grow
    with the logarithm of the longest path. Minima are combined before the shuffle, so a node with very many neighbours
    is no burden; every round is a table in the shared folder. Repeated edges and loops are harmless.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")),
        "labels",
    )
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("root").alias("near"))
        spread = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(spread, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("via")
        )
        further = labels.select(F.col("node").alias("via"), F.col("root").alias("jump"))
        labels = written(
            lower.join(further, "via").select("node", "was", F.least("via", "jump").alias("root")), "labels"
        )
        moved = labels.filter(F.col("root") != F.col("was")).limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
