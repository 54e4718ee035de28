"""Removal of passages that repeat: seeds are winnowed anchors, joined over all documents, extended both ways.

Every window of ``window`` words chooses one anchor: the run of ``gram`` words inside it with
the smallest fingerprint, the last of equals. The choice rests on the window's own words, so
two equal windows, wherever they stand, choose the same anchor at the same place in them. Anchors
are a twelfth of the words. Those found at one place only are dropped by a pre-aggregated
minimum and maximum of their places. What is left is extended: an occurrence of an anchor
reaches left and right over all windows that chose it (at most ``window - gram`` words
each way), and two occurrences extend alike exactly where their windows are equal, which two
independent 64-bit fingerprints tell. Windows that meet an equal one join into maximal
repeats, whose words go.

Occurrences of one anchor are never paired: their windows are sorted and counted. An anchor
with more than ``block_rows`` occurrences is dealt into blocks of about so many. Most of its windows find their
like inside a block; each block also hands on one row for each different window, and those that stand once in
theirs are found in others by a count of these rows and an equi-join, which adaptive execution splits.
Copies of whole texts are counted by the digest of their words, and one of
them stands for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.shared import staged

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: list[bytes], sizes: tuple[int, ...]) -> list[np.ndarray]:
    """The fingerprint of every run of so many words, for each of ``sizes``: a polynomial of the words' hashes, from one running sum."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, len(words)))))
    back = _powers(_INVERSE, len(words))
    return [_mixed((sums[size:] - sums[:-size]) * back[: len(words) - size + 1] + np.uint64(size)) for size in sizes]


def choices(grams: np.ndarray, spread: int) -> np.ndarray:
    """The place of the anchor that each window of ``spread`` runs chooses."""
    view = np.lib.stride_tricks.sliding_window_view(grams, spread)
    return np.arange(len(view)) + spread - 1 - np.argmin(view[:, ::-1], axis=1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _read(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Texts -> their number of words, the digest of their words, and their anchors."""
    for batch in batches:
        counts, digests, anchors, places = [], [], [], []
        for value in batch.column("text"):
            words = words_of(value.as_py())
            counts.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            if len(words) < window:
                anchors.append(np.zeros(0, np.int64))
                places.append(np.zeros(0, np.int32))
                continue
            (grams,) = rolling(words, (gram,))
            at = np.unique(choices(grams, window - gram + 1))
            anchors.append(_signed(grams[at]))
            places.append(at.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tid"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(anchors, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
            ["doc_id", "tid", "n_words", "whole", "anchors", "places"],
        )


def _extend(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Texts with the places of their shared anchors -> each occurrence with the windows that chose it."""
    for batch in batches:
        for tid, value, places in zip(batch.column("tid"), batch.column("text"), batch.column("places"), strict=True):
            words = words_of(value.as_py())
            if len(words) < window:  # another text under the same number
                continue
            grams, whole = rolling(words, (gram, window))
            chosen = choices(grams, window - gram + 1)
            at = np.unique(np.array(places.as_py(), np.int64))
            first, last = np.searchsorted(chosen, at, "left"), np.searchsorted(chosen, at, "right")
            keep = last > first
            at, first, last = at[keep], first[keep], last[keep]
            cuts = np.concatenate(([0], np.cumsum(last - first))).astype(np.int32)
            inside = np.repeat(first - cuts[:-1], last - first) + np.arange(cuts[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(grams[at])), pa.array(np.full(len(at), tid.as_py(), np.int64)), pa.array(first.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(_signed(whole[inside])))],
                ["anchor", "tid", "first", "windows"],
            )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences sorted by anchor and block -> the windows that stand at two places of a block; of dealt anchors also one row for each different window of a block."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        anchor, block = batch.column("anchor").to_numpy(), batch.column("block").to_numpy()
        change = np.flatnonzero((anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]))
        start = int(change[-1]) + 1 if len(change) else 0  # the last block may go on
        held = batch.slice(start)
        if start:
            yield from _counted(batch.slice(0, start))
    if held is not None and held.num_rows:
        yield from _counted(held)


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lists = batch.column("windows")
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), sizes)
    anchor, block, tid, dealt = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("anchor", "block", "tid", "dealt"))
    within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    start = batch.column("first").to_numpy()[row] + within
    mark = lists.flatten().to_numpy()
    order = np.lexsort((start, tid, mark, block, anchor))
    anchor, block, mark, tid, start, dealt = anchor[order], block[order], mark[order], tid[order], start[order], dealt[order]
    new_window = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]) | (mark[1:] != mark[:-1])))
    new_place = new_window | np.concatenate(([True], (tid[1:] != tid[:-1]) | (start[1:] != start[:-1])))
    group = np.cumsum(new_window) - 1
    often = (np.bincount(group, weights=new_place) > 1)[group]
    open_ = np.flatnonzero(new_window & dealt)
    if len(open_):
        alone = ~often[open_]
        # what stands once in its block may stand in another
        starts = pa.ListArray.from_arrays(pa.array(np.arange(len(open_) + 1, dtype=np.int32)), pa.array(start[open_].astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(tid[open_]), starts, pa.array(anchor[open_]), pa.array(mark[open_]), pa.array(alone)], _MET)
    shared = often & new_place
    tid, start = tid[shared], start[shared]
    order = np.lexsort((start, tid))
    tid, start = tid[order], start[order]
    heads = np.flatnonzero(np.concatenate(([True], tid[1:] != tid[:-1]))) if len(tid) else np.zeros(0, np.int64)
    starts = pa.ListArray.from_arrays(pa.array(np.append(heads, len(tid)).astype(np.int32)), pa.array(start.astype(np.int32)))
    none = pa.nulls(len(heads), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(tid[heads]), starts, none, none, pa.nulls(len(heads), pa.bool_())], _MET)


_MET = ["tid", "starts", "anchor", "mark", "alone"]


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, digests = [], []
        for value, starts in zip(batch.column("text"), batch.column("starts"), strict=True):
            words = words_of(value.as_py())
            edges = np.zeros(len(words) + 1, np.int64)
            at = np.unique(np.array(starts.as_py(), np.int64))
            edges[at] += 1
            edges[at + window] -= 1
            kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], ["tid", "cut", "cut_sha256"])


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 12, block_rows: int = 4096) -> DataFrame:
    """documents -> (doc_id, n_words, n_removed, kept_sha256), one row per input row.

    A word goes if a window of ``window`` words over it stands, word for word, at another place of any
    document as well, its own included; windows are judged on the input, so every copy goes.
    Null and empty texts and texts shorter than a window lose nothing. Rows repeated under one doc_id are documents of
    their own, whose words all go once they fill a window; null ids come out as they went
    in. A long text is one row of work, its windows counted like those of many. Other columns are not read. No rows give no rows.
    """
    if not 0 < gram <= window:
        raise ValueError("an anchor has at least one word and fits into the window")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tid"), "text")
    read = staged(
        texts.mapInArrow(lambda it: _read(it, window, gram), "doc_id long, tid long, n_words long, whole string, anchors array<long>, places array<int>"), "repeats-read"
    )
    seeds = read.select("tid", "doc_id", F.explode(F.arrays_zip("anchors", "places")).alias("seed")).select(
        "tid", "doc_id", F.col("seed.anchors").alias("anchor"), F.col("seed.places").alias("place")
    )
    where = F.xxhash64("tid", "place")
    # joined tables are written first, so that both sides of a join come from exchanges and a hot key is split
    joined = staged(seeds.groupBy("anchor").agg(F.min(where).alias("low"), F.max(where).alias("high")).where("low <> high").select("anchor"), "repeats-joined")
    # one row a text: of its copies that with the smallest id carries the words
    wanted = staged(seeds.join(joined, "anchor", "left_semi").groupBy("tid").agg(F.collect_set("place").alias("places"), F.min("doc_id").alias("carrier")), "repeats-wanted")
    carriers = staged(
        texts.join(wanted, "tid").where(F.col("doc_id").eqNullSafe(F.col("carrier"))).select("tid", "text", "places"), "repeats-carriers"
    )
    found = staged(carriers.mapInArrow(lambda it: _extend(it, window, gram), "anchor long, tid long, first int, windows array<long>"), "repeats-windows")
    hot = staged(found.groupBy("anchor").count().where(F.col("count") > block_rows).select("anchor", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "repeats-hot")
    block = F.coalesce(F.pmod(F.xxhash64("tid", "first"), F.col("blocks")), F.lit(0)).cast("int")
    dealt = found.join(hot, "anchor", "left").select("anchor", block.alias("block"), F.col("blocks").isNotNull().alias("dealt"), "tid", "first", "windows")
    met = staged(
        dealt.repartition("anchor", "block").sortWithinPartitions("anchor", "block").mapInArrow(_repeated, "tid long, starts array<int>, anchor long, mark long, alone boolean"), "repeats-met"
    )
    # a window has one row in each block, so two rows are two blocks
    across = staged(met.where("anchor IS NOT NULL").groupBy("anchor", "mark").count().where("count > 1").select("anchor", "mark"), "repeats-across")
    later = met.where("alone").join(across, ["anchor", "mark"], "left_semi").select("tid", "starts")
    starts = met.where("anchor IS NULL").select("tid", "starts").unionByName(later).groupBy("tid").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    cut = staged(
        carriers.select("tid", "text").join(starts, "tid").mapInArrow(lambda it: _remove(it, window), "tid long, cut long, cut_sha256 string").dropDuplicates(["tid"]),
        "repeats-cut",
    )
    copies = staged(read.groupBy("whole").count().where("count > 1").select("whole", F.lit(True).alias("copied")), "repeats-copies")
    rows = read.select("doc_id", "tid", "n_words", "whole").join(copies, "whole", "left").join(cut, "tid", "left")
    gone = F.col("copied") & (F.col("n_words") >= window)
    return rows.select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "whole")).alias("kept_sha256"),
    )
