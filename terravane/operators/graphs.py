"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.operators.lineage import cut


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): root is the smallest node that a node reaches. Nodes are of one type with an order; null ends are left out.

    Each round takes the smallest label among neighbours and then the label's label, so a chain of n nodes takes about log n rounds. Rounds
    are joins on equality over checkpointed tables; a count of changed labels is all that goes to the driver.
    """
    plain = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = cut(plain.unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy("a").agg(F.min("b").alias("n")).select(F.col("a").alias("node"), F.least("a", "n").alias("root")))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = cut(label.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "near").alias("low")))
        up = lower.select(F.col("node").alias("_n"), F.col("low").alias("_up"))
        moved = cut(lower.join(up, F.col("low") == F.col("_n")).select("node", F.col("_up").alias("root"), (F.col("root") != F.col("_up")).alias("changed")))
        label = moved.select("node", "root")
        if not moved.where("changed").limit(1).count():
            return label
