"""Connected components of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import written


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in a link: the least node reachable.

    Each round takes the least label of the neighbours and then the label's own label, so labels
    travel in growing steps. Rounds are written to the shared folder; only the number of changes
    comes to the driver. A node with very many links is a skewed join key, which the runtime
    splits, and is aggregated before its rows are shuffled.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_least"))
    labels = written(labels.select("node", F.least("node", "_least").alias("label")), "labels")
    while True:
        heard = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("_u")).agg(F.min("label").alias("_heard"))
        near = labels.join(heard, labels["node"] == heard["_u"]).select(
            "node", F.col("label").alias("_old"), F.least("label", "_heard").alias("_near"))
        ahead = labels.select(F.col("node").alias("_at"), F.col("label").alias("_ahead"))
        moved = near.join(ahead, near["_near"] == ahead["_at"], "left")
        moved = written(moved.select("node", "_old", F.least("_near", "_ahead").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("label") < F.col("_old")).isEmpty():
            return labels
