"""Chat formatting of reply trees, in DataFrame functions only.

Root-to-leaf paths come from iterated self-joins with doubling: round k leads every node 2^k nodes up and sums the score on
the way, so a path of n turns takes log2(n) joins and n rows in each. The leaves' branches are ranked by their score, and the
paths of the best ones are enumerated by the same jumps, the longest first. Only ids travel through these joins, never lists of
them; texts are joined once to the chosen paths.

Template: a turn is ``### role``, a newline, the text and ``</turn>`` with a newline. ``\\``, ``<`` and ``#`` in roles and texts
become ``\\s``, ``\\l`` and ``\\h`` (and a newline in a role ``\\n``), so no control string can stand inside a turn and the
escape is undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged

TURN_END = "</turn>\n"
_ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # \n must go first: an escaped backslash is \s, so \n stands for nothing else
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _meet(left: DataFrame, right: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """Join ``by`` of the left with ``node`` of the right within a tree; null trees are one tree."""
    other = right.withColumnsRenamed({"tree": "_tree", "node": "_node"})
    return left.join(other, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col(by) == F.col("_node")), how).drop("_tree", "_node")


def branches(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, parent, score) -> leaves (tree, leaf, turns, score) and jumps (tree, node, up).

    A leaf stands for its path from the root: turns long, score summed along it. Table k of the jumps leads 2^k nodes up.
    A parent that is null or names no node of the tree makes a root. Nodes on a cycle reach no root, and
    a leaf below them is left out. Null scores count as 0. Node names are unique within a tree. No nodes give no leaves.
    """
    base = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = base.select("tree", "node", F.lit(True).alias("known"))
    up = F.when(F.col("known"), F.col("parent"))
    state = staged(_meet(base, known, "parent", "left").select("tree", "node", up.alias("up"), F.lit(1).cast("long").alias("turns"), "score"), "chat-jump")
    inner = staged(state.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct(), "chat-inner")
    jumps: list[DataFrame] = []
    ended, most = state.where("up IS NULL"), state.count().bit_length()
    while len(jumps) <= most and not (going := state.where("up IS NOT NULL")).isEmpty():
        jumps.append(going.select("tree", "node", "up"))
        above = state.select("tree", "node", F.col("up").alias("up2"), F.col("turns").alias("more_turns"), F.col("score").alias("more"))
        moved = staged(
            _meet(going, above, "up").select(
                "tree", "node", F.col("up2").alias("up"), (F.col("turns") + F.col("more_turns")).alias("turns"), (F.col("score") + F.col("more")).alias("score")
            ),
            "chat-jump",
        )
        ended = ended.unionByName(moved.where("up IS NULL"))
        # a tree without a node still on its way is done: only the others are looked at again
        live = moved.where("up IS NOT NULL").select(F.col("tree").alias("_tree")).distinct()
        done = state.where("up IS NULL").unionByName(moved.where("up IS NULL")).join(live, F.col("tree").eqNullSafe(F.col("_tree")), "left_semi")
        state = staged(moved.where("up IS NOT NULL").unionByName(done), "chat-state")
    leaves = _meet(ended, inner, "node", "left_anti").select("tree", F.col("node").alias("leaf"), "turns", "score")
    return leaves, jumps


def best(leaves: DataFrame, count: int = 1) -> DataFrame:
    """The ``count`` best leaves of each tree by score, ties to the longer path, then to the smaller leaf; adds branch, from 1."""
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("turns"), "leaf")
    return leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= count)


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """Chosen leaves -> (tree, branch, score, at, node): a row per node of each path, at from 1 at the root.

    The longest jump comes first: each join adds, to the nodes found so far, those one jump above them.
    """
    steps = staged(chosen.select("tree", "branch", "score", F.col("turns").alias("at"), F.col("leaf").alias("node")), "chat-steps")
    for k in reversed(range(len(jumps))):
        above = _meet(steps, jumps[k], "node").select("tree", "branch", "score", (F.col("at") - (1 << k)).alias("at"), F.col("up").alias("node"))
        steps = staged(steps.unionByName(above), "chat-steps")
    return steps


def format_paths(steps: DataFrame, nodes: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows of ``paths`` and (tree, node, role, text) -> tree, branch, score, formatted, spans.

    ``formatted`` is the conversation in the template. ``spans`` lists, in order, the
    (turn, start, skip, chars) of the texts under the loss mask: those of the ``learn`` roles. start is counted in code points from 0 in ``formatted``, skip in the turn, turns from 1.
    Null roles and texts are empty. The work is in proportion to the conversation's length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = nodes.select("tree", "node", role.alias("role"), text.alias("text"))
    turns = (
        _meet(steps, said, "node")
        .select(
            "tree", "branch", "score", "at",
            F.concat(F.lit("### "), escape_role(F.col("role")), F.lit("\n")).alias("head"),
            escape(F.col("text")).alias("body"),
            F.col("role").isin(*learn).alias("learn"),
        )
    )
    size = F.length("head") + F.length("body") + len(TURN_END)
    before = Window.partitionBy("tree", "branch").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("begins", F.coalesce(F.sum(size).over(before), F.lit(0)))
    span = F.struct(F.col("at").cast("int").alias("turn"), (F.col("begins") + F.length("head")).alias("start"), F.length("head").alias("skip"), F.length("body").alias("chars"))
    turn = F.struct("at", F.concat("head", "body", F.lit(TURN_END)).alias("piece"), F.when(F.col("learn"), span).alias("span"))
    whole = turns.groupBy("tree", "branch").agg(F.first("score").alias("score"), F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "tree", "branch", "score",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.array_compact(F.col("turns.span")).alias("spans"),
    )


def parse(formatted: Column) -> Column:
    """The template undone: array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted, TURN_END.replace("\n", "\\n"), -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substr(F.substring_index(p, "\n", 1), F.lit(5))).alias("role"),
            unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text"),
        ),
    )


def learned(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined without a separator. The conversation is cut into its turns once, and each span read from its own turn."""
    turns = F.split(formatted, TURN_END.replace("\n", "\\n"), -1)
    # as the one element of an array, the turns are bound once and not cut anew for every span
    cut = F.transform(F.array(turns), lambda t: F.array_join(F.transform(spans, lambda s: unescape(F.substr(F.get(t, s["turn"] - 1), s["skip"] + 1, s["chars"]))), ""))
    return F.get(cut, F.lit(0))


def linear_nodes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> a tree per conversation in which each turn answers the one before.

    Ties of turn are ordered by role and text, a null as an empty one, so equal rows follow each other; rows without a turn come first. Null conversation ids form one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    node = F.row_number().over(order).cast("long")
    return turns.select(F.col("conv_id").alias("tree"), node.alias("node"), "role", "text").withColumn(
        "parent", F.when(F.col("node") > 1, F.col("node") - 1)
    ).withColumn("score", F.lit(0.0))
