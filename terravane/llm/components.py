"""Connected components over an edge table, by alternating large-star and small-star rounds.

Every round is two pre-aggregated minima and two equi-joins between freshly
exchanged tables, so a node with very many neighbours is split by the
adaptive skew join and never meets in one task. Nothing goes to the driver but two sums
a round that tell whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.shared import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1_000_003)), F.sum(F.xxhash64("v", "u") % F.lit(998_244_353))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, root): root is the smallest node that node reaches.

    Self-loops and repeated edges change nothing; nodes without an edge to another
    node are absent; no edges give an empty table.
    """
    e = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc-edges"
    )
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m")), "cc-large-min")
        large = staged(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large"
        )
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "cc-small-min")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
