"""Joins that check their cardinality, and matches that refuse to guess.

No side is forced to broadcast: Catalyst and adaptive execution choose by the sizes they know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def many_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that fails when it runs if any key of the right side repeats, whichever columns are read of it.

    The check is a condition on the joined rows, so no pruning of columns takes it out of the plan.
    """
    rest = [c for c in right.columns if c not in keys]
    once = right.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rest) if rest else F.lit(True)).alias("_row"))
    told = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    worst = once.agg(F.max(F.struct("_n", told.alias("keys"))).alias("_worst"))  # one row
    fits = F.coalesce(F.col("_worst._n"), F.lit(1)) == 1
    failed = F.raise_error(F.concat(F.lit(f"keys {keys} repeat: "), F.col("_worst.keys"))).cast("boolean")
    joined = left.crossJoin(worst).where(F.when(fits, True).otherwise(failed)).join(once, keys, "left")
    return joined.select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in rest])


def densify(left: DataFrame, right: DataFrame, facts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Every combination of two dimensions with its facts, absent ones as 0. The grid is the result, so its size is what was asked for."""
    return left.crossJoin(right).join(facts, keys, "left").fillna(0, measures)


def argmax(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row of each group, the first by ``order``; the order must be total for the result to be determined."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def unique_match(requests: DataFrame, candidates: DataFrame, keys: list[str], candidate_id: str) -> DataFrame:
    """Accepts a candidate only where it is the only one: status is matched, ambiguous or unmatched."""
    per = candidates.groupBy(*keys).agg(F.count_distinct(candidate_id).alias("candidates"), F.min(candidate_id).alias("_only"))
    n = F.coalesce("candidates", F.lit(0))
    return requests.join(per, keys, "left").withColumn("candidates", n).withColumn(
        "status", F.when(F.col("candidates") == 0, "unmatched").when(F.col("candidates") == 1, "matched").otherwise("ambiguous")
    ).withColumn(candidate_id, F.when(F.col("candidates") == 1, F.col("_only"))).drop("_only")


def dominant_match(candidates: DataFrame, by: list[str], weight: str, tie: str, least: float = 10_000, ratio: float = 3.0) -> DataFrame:
    """The heaviest candidate of each group if it stands alone, or is at least ``least`` and ``ratio`` times the second.

    The two heaviest are the first two of a group-limited ranking, so each task hands on two rows a group.
    """
    w = Window.partitionBy(*by).orderBy(F.desc(weight), F.asc(tie))
    two = candidates.withColumn("_place", F.row_number().over(w)).where("_place <= 2")
    rest = [c for c in candidates.columns if c not in by]
    out = two.groupBy(*by).agg(F.min(F.struct("_place", *rest)).alias("_top"), F.max(F.when(F.col("_place") == 2, F.col(weight))).alias("second"))
    return out.select(*by, *[F.col(f"_top.{c}").alias(c) for c in rest], "second").withColumn(
        "accepted", F.col("second").isNull() | ((F.col(weight) >= least) & (F.col(weight) >= ratio * F.col("second")))
    )


def parent_chain(nodes: DataFrame, node: str, parent: str, value: str, hops: int = 2) -> DataFrame:
    """The value of a node, or of the nearest ancestor within ``hops`` that has one."""
    look = nodes.select(F.col(node).alias("_n"), F.col(parent).alias("_p"), F.col(value).alias("_v"))
    out = nodes.withColumn("_up", F.col(parent)).withColumn("resolved", F.col(value))
    for _ in range(hops):
        out = out.join(look, F.col("_up") == F.col("_n"), "left").withColumn("resolved", F.coalesce("resolved", "_v")).withColumn("_up", F.col("_p")).drop("_n", "_p", "_v")
    return out.drop("_up")


def override(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace rows of ``base`` with their keys; new keys are added."""
    return base.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


# Fixed value: about so many rows of an input meet in one task of ``dealt``.
ROWS_OF_A_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many partitions as ``rows``, its number of rows or a bound of it, ask for, so that what a task holds does not grow with the input.

    Where the session's own number of shuffle partitions is enough ``df`` is returned as it is, and the planner deals it.
    """
    n = -(-rows // ROWS_OF_A_TASK)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
