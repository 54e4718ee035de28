"""The trie of conversation prefixes: fingerprints of all prefixes, checked groups, sums over subtrees.

A conversation's turns are rows in order. One scan over rows sorted by conversation gives each
prefix a polynomial fingerprint, as a running sum of numpy: fp(d) = sum of t(i) B^i over
its turns. Rows of equal depth and fingerprint are a candidate node. A group is verified turn
by turn: all its members must have the representative's last turn (by SHA-256) and the
representative's parent group; as parents are verified alike, a group that passes holds one prefix.
The test is the equality of a pre-aggregated minimum, the representative's, and maximum. Groups that fail are split: their
rows get a second fingerprint of their own turn and parent, which the next scan carries down to
all that follow; rounds end when every group passes, which is the first with 64 bits.

No walk over levels: a node is owned by its smallest conversation, so each node
of a subtree is counted once if every member adds what it owns from there down, and sums over
subtrees are sums of running sums over members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged

_BASE = 0x9E3779B97F4A7C15
KEY = ["depth", "fp", "split"]
_SCANNED = "conv_id long, place long, digest binary, words long, mark long, depth long, fp long, split long, above_fp long, above_split long, last boolean"


def ordered(turns: DataFrame) -> DataFrame:
    """conversations -> (conv_id, i, digest, words): turns numbered from 1 by turn, null first, ties by role and text; rows without a conv_id take no part."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    told = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    by = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select(
        "conv_id", F.row_number().over(by).alias("i"), F.unhex(F.sha2(told.cast("binary"), 256)).alias("digest"),
        F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations with borrowed beginnings -> (conv_id, place, digest, words), with a textless row at place 0 for each.

    Conversation c begins with the first h turns of conversation c - c % every (all of them
    if there are fewer, none if it is absent) and goes on with its own after its first h; h is crc32(c) % most.
    A conversation lends its first turns to ``every`` others at most.
    """
    own = staged(ordered(turns), "trie-turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    ids = own.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    lent = own.where((F.col("conv_id") % every == 0) & (F.col("i") < most)).select(F.col("conv_id").alias("base"), "i", "digest", "words")
    begun = ids.join(lent, "base").where("i <= h").select("conv_id", F.col("i").cast("long").alias("place"), "digest", "words")
    rest = own.where(F.col("i") > h).select("conv_id", (F.col("i") + most).cast("long").alias("place"), "digest", "words")
    roots = ids.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("words"))
    return roots.unionByName(begun).unionByName(rest)


def _prefixes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place -> their depth, both fingerprints and the parent's."""
    mask = np.uint64((1 << bits) - 1)
    held, open_id, depth0, sums0 = None, None, -1, np.zeros(2, np.uint64)
    powers = np.ones(1, np.uint64)

    def scanned(batch: pa.RecordBatch, ended: np.ndarray) -> pa.RecordBatch:
        nonlocal open_id, depth0, sums0, powers
        ids = batch.column("conv_id").to_numpy()
        n = len(ids)
        new = np.concatenate(([ids[0] != open_id], ids[1:] != ids[:-1]))
        head = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: goes on from the batch before
        depth = np.where(head >= 0, np.arange(n) - head, depth0 + 1 + np.arange(n))
        if depth.max() >= len(powers):
            steps = np.full(int(depth.max()) * 2 + 2, _BASE, np.uint64)
            steps[0] = 1
            powers = np.multiply.accumulate(steps)
        found = []
        for k, name in enumerate(("turn", "mark")):
            value = batch.column(name).to_numpy().view(np.uint64)
            value = np.where(depth > 0, value, np.uint64(0)) if name == "turn" else value
            run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * powers[depth])))
            before = np.where(head >= 0, run[head], (np.uint64(0) - sums0)[k])
            found.append((run[1:] - before, run[:-1] - before))
        open_id, depth0 = ids[-1], int(depth[-1])
        sums0 = np.array([found[0][0][-1], found[1][0][-1]], np.uint64)
        (fp, above_fp), (split, above_split) = found
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "place", "digest", "words", "mark")), pa.array(depth), *(pa.array(x.view(np.int64)) for x in (fp & mask, split, above_fp & mask, above_split)), pa.array(ended)],
            ["conv_id", "place", "digest", "words", "mark", "depth", "fp", "split", "above_fp", "above_split", "last"],
        )

    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        ids, held = batch.column("conv_id").to_numpy(), batch.slice(batch.num_rows - 1)
        if batch.num_rows > 1:
            yield scanned(batch.slice(0, batch.num_rows - 1), ids[1:] != ids[:-1])
    if held is not None:
        yield scanned(held, np.ones(1, bool))


def prefixes(rows: DataFrame, bits: int = 64, rounds: int = 64) -> DataFrame:
    """(conv_id, place, digest, words) -> a row per conversation and depth with its verified node ``KEY`` and whether the conversation ends there.

    ``bits`` of the fingerprint are used; fewer bits give more collisions, never another trie.
    """
    now = rows.withColumn("mark", F.lit(0).cast("long"))
    for _ in range(rounds):
        turn = now.select("conv_id", "place", "digest", "words", "mark", F.xxhash64("digest").alias("turn"))
        scan = staged(turn.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(lambda it: _prefixes(it, bits), _SCANNED), "trie-prefixes")
        parts = ("digest", "above_fp", "above_split")
        tested = scan.groupBy(*KEY).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in parts for f in (F.min, F.max)])
        failed = staged(tested.where(" OR ".join(f"min_{c} <> max_{c}" for c in parts)).select(*KEY, F.lit(True).alias("failed")), "trie-failed")
        if failed.isEmpty():
            return scan
        own = F.xxhash64("above_fp", "above_split", "digest")
        marked = scan.join(failed, KEY, "left").withColumn("mark", F.col("mark") + F.when(F.col("failed"), own).otherwise(F.lit(0)))
        now = marked.select("conv_id", F.col("depth").alias("place"), "digest", "words", "mark")
    raise RuntimeError("fingerprints did not part in so many rounds")


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation -> runs of one node's ids as text, at most ``rows`` each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in KEY]
        ids = batch.column("conv_id").to_numpy()
        heads = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))
        cuts = [x for a, b in zip(heads, np.append(heads[1:], len(ids)), strict=True) for x in range(a, b, rows)]
        told = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
        yield pa.RecordBatch.from_arrays([*(pa.array(k[cuts]) for k in keys), pa.array(ids[cuts]), pa.array(told, pa.string())], [*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by node and first id -> one SHA-256 per node over all its ids; only one digest is open at a time."""
    key, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for row in zip(*(batch.column(c).to_pylist() for c in KEY), batch.column("ids").to_pylist(), strict=True):
            if row[:3] == key:
                digest.update(b"," + row[3].encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = row[:3], hashlib.sha256(row[3].encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], [*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], [*KEY, "ends_sha256"])


def trie(rows: DataFrame, bits: int = 64, chunk_rows: int = 4096) -> DataFrame:
    """(conv_id, place, digest, words) -> a row per node of the trie of all prefixes.

    conv_id is the smallest member, saved_tokens what keeping each node's last turn once saves in its subtree, ends_sha256
    the digest of the members that end at the node. No conversations give no rows, not even a root. The ids that end at one
    node are put in order by a range exchange, and only their runs of ``chunk_rows`` go to
    the task that digests them.
    """
    scan = prefixes(rows, bits)
    nodes = scan.groupBy(*KEY).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.sum(F.col("last").cast("long")).alias("n_ends"))
    nodes = staged(nodes, "trie-nodes")
    member = scan.select("conv_id", *KEY, "words", "last").join(nodes, KEY)
    own = F.col("conv_id") == F.col("owner")
    leaf = own & F.col("last") & (F.col("n_ends") == F.col("n_convs"))
    upward = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    through = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = F.sum(F.when(own, 0).otherwise(F.col("words"))).over(through)
    told = member.select(
        *KEY, "owner", "n_convs", said.alias("repeated"), F.sum(leaf.cast("long")).over(through).alias("leaves"),
        F.coalesce(F.lag(own.cast("long")).over(upward), F.lit(0)).alias("child"), F.lead("owner").over(upward).alias("parent"),
    )
    summed = told.groupBy(*KEY).agg(
        F.min("owner").alias("owner"), F.min("n_convs").alias("n_convs"), F.min("parent").alias("parent_conv_id"),
        F.sum("child").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("repeated").alias("saved_tokens"),
    )
    by = [*KEY, "conv_id"]
    ends = scan.where("last").select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(lambda it: _chunks(it, chunk_rows), "depth long, fp long, split long, first long, ids string")
    digests = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "depth long, fp long, split long, ends_sha256 string")
    return summed.join(digests, KEY, "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )
