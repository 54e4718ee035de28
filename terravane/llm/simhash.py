"""SimHash near-duplicate classes through a segment-popcount grid.

A fingerprint is cut into segments of ``segment_bits`` bits and embedded as the
vector of their popcounts. One differing bit moves one count by one, so the
Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints: fingerprints within ``radius`` bits lie within ``radius`` on the
grid. The counts are put into ``radius // 2 + 1`` runs; by the pigeonhole
principle at least one run is within Manhattan distance one. Each fingerprint
therefore files itself under its cell of each run, and those whose counts sum
to an odd number also probe the cells one step away (a pair one step
apart has sums of different parity, so one of the two probes the other). Every
pair that meets is verified by its exact Hamming distance.

Cells with more than ``block_rows`` filed fingerprints are dealt into blocks; each
block meets every probe of the cell in its own task, so no task holds
more than ``block_rows`` fingerprints of a cell and none is left out. Within a task,
verified links are reduced to a spanning forest before they leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.components import components
from terravane.llm.shared import staged

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a whole text, signed.

    ASCII letters are lower-cased, words end at ASCII white space, shingles count as often as
    they occur; fewer words than a shingle make one shingle, and no word (also
    null) gives zero. A bit is set if more than half the shingle hashes have it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(flat, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[s:e], seed) for s, e in zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)]
    total = np.zeros(2048, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.bincount((part + _COLUMN).ravel(), minlength=2048)
    ones = (total.reshape(8, 256) @ _BYTE_BITS).ravel()
    value = int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, shingle_words: int = 3, seed: int = 42, carry: tuple[str, ...] = ()) -> DataFrame:
    """documents -> (doc_id, fp); other columns are not read, whatever their names, but those in ``carry`` come along as a struct ``row``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.struct(*carry).alias("row")] if carry else []))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *([rows.schema["row"]] if carry else [])])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64()), *([batch.column("row")] if carry else [])], names)

    return rows.mapInArrow(run, schema)


def segment_counts(fps: np.ndarray, segment_bits: int) -> np.ndarray:
    """Popcount of each segment, (n, 64 / segment_bits)."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), -1, segment_bits).sum(axis=2, dtype=np.int8)


def _runs(segment_bits: int, radius: int) -> list[np.ndarray]:
    return np.array_split(np.arange(64 // segment_bits), min(radius // 2 + 1, 64 // segment_bits))


def grid_rows(fps: np.ndarray, segment_bits: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, fp, probe): one filed row a run, and the probes of odd fingerprints. The cell number holds the run."""
    counts, cells, owners, probes = segment_counts(fps, segment_bits), [], [], []
    for k, run in enumerate(_runs(segment_bits, radius)):
        part = counts[:, run].astype(np.int64)
        step = (segment_bits + 1) ** np.arange(len(run), dtype=np.float64)
        # the mixed-radix number may exceed 63 bits for one-bit segments of a single run; wrap-around keeps it a hash, and the verification is exact
        step = np.array([pow(segment_bits + 1, i) & ((1 << 56) - 1) for i in range(len(run))], np.int64) if step[-1] >= 2**56 else step.astype(np.int64)
        code = part @ step + (np.int64(k) << 57)
        cells.append(code)
        owners.append(fps)
        probes.append(np.zeros(len(fps), np.int8))
        if radius:
            odd = part.sum(axis=1) % 2 == 1
            for i in range(len(run)):
                for d, ok in ((1, part[:, i] < segment_bits), (-1, part[:, i] > 0)):
                    at = np.flatnonzero(odd & ok)
                    cells.append(code[at] + d * step[i])
                    owners.append(fps[at])
                    probes.append(np.ones(len(at), np.int8))
    return np.concatenate(cells), np.concatenate(owners), np.concatenate(probes)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> (node, smallest node of its class) for every node that is not that smallest one."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v, label = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = np.minimum(new, new[label])
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[at], nodes[label[at]]


def _link(batches: Iterator[pa.RecordBatch], radius: int, pairs_at_once: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cell, block, probe): pairs each row with the filed rows before it in its block."""
    empty = np.zeros(0, np.int64)
    kept_cell, kept_block, kept_fp = empty, empty, empty  # filed rows of the block that is still open
    for batch in batches:
        cell, block, fp, probe = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "fp", "probe"))
        old = len(kept_fp)
        cell, block, fp = np.concatenate((kept_cell, cell)), np.concatenate((kept_block, block)), np.concatenate((kept_fp, fp))
        probe = np.concatenate((np.zeros(old, np.int8), probe))
        if not len(cell):
            continue
        first = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]))))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(cell))))
        filed = np.bincount(group, weights=probe == 0, minlength=len(first)).astype(np.int64)
        partners = np.minimum(np.arange(len(cell)) - first[group], filed[group])
        partners[:old] = 0
        busy = np.flatnonzero(partners)
        ends = np.cumsum(partners[busy])
        at = 0
        while at < len(busy):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + pairs_at_once, "right")))
            rows = busy[at:to]
            n = partners[rows]
            left = np.repeat(rows, n)
            right = np.repeat(first[group[rows]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            close = np.bitwise_count(fp[left].view(np.uint64) ^ fp[right].view(np.uint64)) <= radius
            if close.any():
                node, root = forest(fp[left[close]], fp[right[close]])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])
            at = to
        tail = slice(first[-1], first[-1] + filed[-1])
        kept_cell, kept_block, kept_fp = cell[tail], block[tail].astype(np.int64), fp[tail]


def links(fps: DataFrame, radius: int = 3, segment_bits: int = 2, block_rows: int = 4096) -> DataFrame:
    """(fp) distinct -> (a, b): links whose classes are those of all pairs within ``radius`` bits."""
    if 64 % segment_bits:
        raise ValueError("segment_bits must divide 64")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 1 << 14):
                cell, fp, probe = grid_rows(values[at : at + (1 << 14)], segment_bits, radius)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp), pa.array(probe)], ["cell", "fp", "probe"])

    grid = fps.select("fp").mapInArrow(rows, "cell long, fp long, probe byte")
    hot = staged(
        grid.where("probe = 0").groupBy("cell").count().where(F.col("count") > block_rows)
        .select("cell", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")),
        "simhash-hot-cells",
    )
    if hot.isEmpty():
        grid = grid.withColumn("block", F.lit(0))
    else:
        home = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        grid = (
            grid.join(hot, "cell", "left")
            .withColumn("home", F.when(F.col("blocks").isNotNull(), home))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
            .where("blocks IS NULL OR probe = 1 OR block <= home")
            .withColumn("probe", F.expr("cast(if(blocks IS NOT NULL AND block < coalesce(home, block), 1, probe) as byte)"))
        )
    placed = grid.select("cell", "block", "fp", "probe").repartition("cell", "block").sortWithinPartitions("cell", "block", "probe")
    return placed.mapInArrow(lambda it: _link(it, radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, radius: int = 3, seed: int = 42, segment_bits: int = 2, block_rows: int = 4096
) -> DataFrame:
    """documents -> (doc_id, fp, component_id, class_fp), one row per input row.

    component_id is the smallest doc_id whose fingerprint can be reached by steps of
    at most ``radius`` differing bits. Texts without a word (null, empty, white space) share the
    fingerprint zero and are linked like any other. Rows repeated with one doc_id come out as
    often as they went in. A null doc_id takes no part in the minimum; a class
    of null ids alone has no component_id. class_fp, its smallest fingerprint, names every class. No rows give no rows.
    """
    owned = staged(fingerprints(docs, shingle_words, seed), "simhash-fp")
    distinct = staged(owned.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    member = components(links(distinct, radius, segment_bits, block_rows))
    root_of = member.unionByName(member.select(F.col("root").alias("node"), "root").distinct())
    root_of = staged(root_of.join(distinct.withColumnRenamed("fp", "node"), "node"), "simhash-members")
    class_id = staged(root_of.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-classes")
    linked = root_of.join(class_id, "root").select(F.col("node").alias("fp"), "component_id", F.col("root").alias("class_fp"))
    resolved = staged(
        distinct.join(linked, "fp", "left").select(
            "fp", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("class_fp", "fp").alias("class_fp")
        ),
        "simhash-resolved",
    )
    return owned.join(resolved, "fp").select("doc_id", "fp", "component_id", "class_fp")


def digits(fp: Column) -> Column:
    """16 lower-case hex digits of a signed 64-bit fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
