"""Mixing sources to target weights by hierarchical budgeting.

The leaves are (domain, language, source). A token budget goes down the tree by the weights of each
level. Where a subtree cannot use its share (its tokens times ``max_epochs`` are fewer), the shortage
goes to its siblings in proportion to their weights, and only what all siblings together cannot take goes up to the
parent, whose own siblings are next. Among siblings that is a water level: each gets its weight times the level, or its cap where that is
less. With the siblings in the order of cap over weight the level is the largest of (budget - caps before) / (weights from here on), so a
level of the tree is one window pass over its nodes, and no leaf goes to the driver.

Each leaf then takes a prefix of its token stream: epoch after epoch, documents in the order of
a seeded hash, whole documents while the running sum of tokens stays within the leaf's budget. Rows that are equal in id and text are
one entry with their number, so a repeated or missing id cannot fill a bucket. The running sum is taken in hash-range buckets of about ``bucket_rows``
entries, whose starts are sums over the buckets' totals, so a leaf with a third of all rows is summed by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged

LEVELS = ("domain", "language", "origin")
COPIES_AT_ONCE = 1000


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null counts as empty."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def _hex(digits: Column, count: int) -> Column:
    """The first hex digits as a number; fifteen fit."""
    return F.conv(F.substring(digits, 1, count), 16, 10).cast("long")


def text_mark(text: Column) -> Column:
    """Sixty bits of a text's MD5; null counts as empty."""
    return _hex(F.md5(F.coalesce(text, F.lit(""))), 15)


def water_fill(nodes: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """(.., wants, cap, budget) with the parent's budget in every row -> the same with ``got``: the budget divided by weight among the siblings, none above its cap."""
    open_ = (F.col("wants") > 0) & (F.col("cap") > 0)
    rows = nodes.withColumn("wants", F.when(open_, F.col("wants")).otherwise(0.0)).withColumn("cap", F.when(open_, F.col("cap")).otherwise(0.0))
    rows = rows.withColumn("ratio", F.when(open_, F.col("cap") / F.col("wants")))
    siblings = Window.partitionBy(*parent, *([] if parent else [F.lit(0)]))
    order = siblings.orderBy(F.asc_nulls_last("ratio"), *[c for c in LEVELS if c in nodes.columns])
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("wants").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.when(F.col("ratio").isNotNull(), (F.col("budget") - before) / onward)
    rows = rows.withColumn("level", level)
    got = F.greatest(F.least(F.col("cap"), F.col("wants") * F.max("level").over(siblings)), F.lit(0.0))
    return rows.withColumn("got", F.coalesce(got, F.lit(0.0))).drop("ratio", "level")


def leaf_budgets(leaves: DataFrame, weights: Mapping[tuple[str, ...], float] | None, budget_share: float, max_epochs: int = 1) -> DataFrame:
    """(domain, language, origin, leaf_tokens, n) -> the same with ``leaf_budget``.

    ``weights`` maps a node's path (1 to 3 names) to its weight among its siblings; 1 where absent, and 0 shuts the subtree out. The budget is
    ``budget_share`` of all tokens, or what the leaves can give in ``max_epochs`` if that is less.
    """
    spark, given = leaves.sparkSession, dict(weights or {})

    def weighed(df: DataFrame, depth: int) -> DataFrame:
        named = [(*path, float(w)) for path, w in given.items() if len(path) == depth]
        schema = ", ".join([*(f"{c} string" for c in LEVELS[:depth]), f"w{depth} double"])
        return df.join(spark.createDataFrame(named, schema), list(LEVELS[:depth]), "left").withColumn(f"w{depth}", F.coalesce(f"w{depth}", F.lit(1.0)))

    rows = leaves
    for depth in (1, 2, 3):
        rows = weighed(rows, depth)
    # a weight of zero anywhere on the path shuts the leaf out, so it must not count as room above
    room = (F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0)
    rows = staged(rows.withColumn("room", F.when(room, F.col("leaf_tokens") * F.lit(float(max_epochs))).otherwise(0.0)), "mix-weights")
    whole = rows.agg((F.sum("leaf_tokens") * F.lit(budget_share)).alias("asked"), F.sum("room").alias("room")).first()
    total = min(whole.asked or 0.0, whole.room or 0.0)
    above = None
    for depth in (1, 2, 3):
        names = LEVELS[:depth]
        nodes = rows.groupBy(*names).agg(F.first(f"w{depth}").alias("wants"), F.sum("room").alias("cap"))
        nodes = nodes.withColumn("budget", F.lit(total)) if above is None else nodes.join(above, list(names[:-1]))
        above = water_fill(nodes, names[:-1]).select(*names, F.col("got").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "leaf_budget"), list(LEVELS))


def _draw(seed: int, epoch: Column, doc_id: Column, mark: Column) -> Column:
    """An entry's place in its leaf's epoch; buckets are ranges of it. Null ids are spread by their marks."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(doc_id.cast("string"), F.lit("null")), mark))


def _chosen(keyed: DataFrame, weights: Mapping[tuple[str, ...], float] | None, budget_share: float, max_epochs: int, seed: int, bucket_rows: int) -> DataFrame:
    """The chosen entries: with their draw, where they begin in the leaf's stream, and how many of their copies fit."""
    mark = F.col("mark") if "mark" in keyed.columns else F.col("tokens")
    entries = staged(
        keyed.select(F.col("doc_id").cast("long").alias("doc_id"), *LEVELS, F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), mark.cast("long").alias("mark"))
        .groupBy("doc_id", *LEVELS, "tokens", "mark").agg(F.count("*").alias("copies")),
        "mix-entries",
    )
    leaves = staged(entries.groupBy(*LEVELS).agg(F.sum(F.col("tokens") * F.col("copies")).alias("leaf_tokens"), F.count("*").alias("n")), "mix-leaves")
    plan = leaf_budgets(leaves, weights, budget_share, max_epochs)
    used = F.when(F.col("leaf_tokens") > 0, F.least(F.lit(max_epochs), F.floor(F.col("leaf_budget") / F.col("leaf_tokens")) + 1)).otherwise(1)
    plan = staged(plan.select(*LEVELS, "leaf_budget", F.ceil(F.col("n") / bucket_rows).cast("int").alias("buckets"), used.cast("int").alias("epochs")).where("leaf_budget > 0"), "mix-plan")
    bucket = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("buckets")).cast("int")
    drawn = (
        entries.join(plan, list(LEVELS))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)))
        .withColumn("draw", _draw(seed, F.col("epoch"), F.col("doc_id"), F.col("mark")))
        .withColumn("bucket", bucket)
        .withColumn("weight", F.col("tokens") * F.col("copies"))
    )
    drawn = staged(drawn, "mix-drawn")
    cells = drawn.groupBy(*LEVELS, "epoch", "bucket").agg(F.sum("weight").alias("cell_tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        cells.select(*LEVELS, "epoch", "bucket", F.coalesce(F.sum("cell_tokens").over(before), F.lit(0)).alias("start")), "mix-cells"
    )
    inside = Window.partitionBy(*LEVELS, "epoch", "bucket").orderBy("draw", "doc_id", "mark", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    summed = drawn.withColumn("run", F.coalesce(F.sum("weight").over(inside), F.lit(0))).join(starts, [*LEVELS, "epoch", "bucket"]).withColumn("begins", F.col("start") + F.col("run"))
    left = F.col("leaf_budget") + 1e-6 - F.col("begins")
    fits = F.when(left < 0, 0).when(F.col("tokens") == 0, F.col("copies")).otherwise(F.least(F.col("copies"), F.floor(left / F.col("tokens"))))
    return summed.withColumn("fits", fits.cast("long")).where("fits > 0")


def mix(
    keyed: DataFrame,
    weights: Mapping[tuple[str, ...], float] | None = None,
    budget_share: float = 0.5,
    max_epochs: int = 1,
    seed: int = 17,
    bucket_rows: int = 2000,
) -> DataFrame:
    """(doc_id, domain, language, origin, tokens[, mark]) -> the chosen (doc_id, domain, language, origin, tokens, epoch, leaf_budget, tokens_through).

    The budget is ``budget_share`` of all tokens. A row can be chosen once in each epoch. Every leaf chooses at most its
    budget and stops at the first document that would pass it. Rows without tokens are chosen with whatever prefix reaches them.
    ``mark`` tells texts apart (a hash of them); where it is absent the tokens stand for it. Repeated rows are separate rows that follow one another, each with its own
    tokens_through. Null ids are ids like others, null tokens count as 0, and null level names form leaves of their own only after ``tree_columns`` has named them. Other columns are not read. No rows give no rows.
    """
    if max_epochs < 1 or budget_share < 0 or bucket_rows < 1:
        raise ValueError("max_epochs and bucket_rows must be positive, budget_share not negative")
    chosen = _chosen(keyed, weights, budget_share, max_epochs, seed, bucket_rows)
    # an entry of very many copies is told by many tasks
    piece = F.sequence(F.lit(0).cast("long"), F.floor((F.col("fits") - 1) / COPIES_AT_ONCE))
    few = chosen.where(F.col("fits") <= COPIES_AT_ONCE).withColumn("piece", F.lit(0).cast("long"))
    many = chosen.where(F.col("fits") > COPIES_AT_ONCE).withColumn("piece", F.explode(piece)).repartition("doc_id", "mark", "epoch", "piece")
    first = F.col("piece") * COPIES_AT_ONCE + 1
    number = F.explode(F.sequence(first, F.least(F.col("fits"), first + (COPIES_AT_ONCE - 1))))
    told = few.unionByName(many).withColumn("number", number)
    return told.select("doc_id", *LEVELS, "tokens", "epoch", "leaf_budget", (F.col("begins") + F.col("tokens") * F.col("number")).cast("long").alias("tokens_through"))


def tree_columns(docs: DataFrame, domains: int = 4) -> DataFrame:
    """documents -> (doc_id, domain, language, origin, tokens, mark). The tables have no domain, so a source's hash names one; nulls become ``none``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_leaf(domains), word_count(F.col("text")).alias("tokens"), text_mark(F.col("text")).alias("mark"))


def _leaf(domains: int) -> list[Column]:
    origin = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    return [
        F.concat(F.lit("domain"), (_hex(F.md5(origin), 8) % domains).cast("string")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("none")).alias("language"),
        origin.alias("origin"),
    ]


def mixed_documents(
    docs: DataFrame, weights: Mapping[tuple[str, ...], float] | None = None, budget_share: float = 0.5, seed: int = 17, domains: int = 4
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``mix`` chooses in one epoch.

    A leaf's choice is a prefix of its order, so its last chosen place tells all of it: each row is compared with that one place,
    and texts are neither shuffled nor joined by id. Rows equal to a leaf's last chosen one in id and text stay with it. Null ids are ids like others.
    A leaf with no chosen row keeps none. No rows give no rows.
    """
    ends = staged(_chosen(tree_columns(docs, domains), weights, budget_share, 1, seed, 2000).groupBy(*LEVELS).agg(F.max(F.struct("draw", "doc_id", "mark")).alias("end")), "mix-ends")
    rows = docs.select(F.struct("*").alias("row"), *_leaf(domains)).join(ends, list(LEVELS))
    doc_id, mark = F.col("row.doc_id").cast("long"), text_mark(F.col("row.text"))
    place = F.struct(_draw(seed, F.lit(0), doc_id, mark).alias("draw"), doc_id.alias("doc_id"), mark.alias("mark"))
    return rows.where(place <= F.col("end")).select("row.*")
