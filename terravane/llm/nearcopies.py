"""Near-copy classes by the exact Jaccard similarity of word shingles.

A text is the set of its runs of ``shingle_words`` words; two texts are linked if their sets are at least ``similarity``
alike, and classes are what links reach. Pairs to compare come from the SimHash classes of the same shingles (``simhash``, its popcount grid) and, as few pairs
at 0.8 lie within its three bits and a grid of twelve bits meets nearly all pairs, from MinHash bands: a cell is a band's minima, a SimHash class is one cell more,
and texts that meet in no cell are not compared. With 25 bands of five minima a pair of similarity 0.8 meets in some cell with
probability 0.99995, one of 0.9 always but for one in 10^9. No other step loses a pair. Texts are told by a 64-bit hash.

Cells are joined to their smallest text by equi-joins, whose classes are the candidate classes. A text's set is
shipped once to its candidate class and compared there with the texts it shares a cell with, less those already
linked to it. Candidate classes of more than ``block_rows`` texts are first compared with one pivot; texts linked to it need
no comparison with one another, and the others are dealt into blocks that every text of the class passes by. As cells chain, a class can grow with the corpus: where the texts unlike the pivot would
make more blocks than a text has cells (26), sets are filed by cell instead, at most once for each cell, and only a cell of more than ``block_rows`` texts is cut: by a pivot of its own, then into blocks
that the cell's texts pass by in lanes of about ``block_rows``. So no task holds or reads many more than ``block_rows`` sets at a time and none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm import simhash
from terravane.llm.components import components
from terravane.llm.shared import staged

BANDS, ROWS = 25, 5
_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_TURNS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the lower-cased words; fewer words than a shingle make one, no word (also null) gives [0]."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(1, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(w) for w in "\n".join(words).encode("utf-8", "surrogatepass").split(b"\n")], np.uint64)
    size = min(shingle_words, len(h))
    runs = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        runs = runs * _PRIME + h[i : len(h) - size + 1 + i]
    return np.unique(_mixed(runs))


def cells(shingles: np.ndarray) -> np.ndarray:
    """One cell a band: the hash of the band's minima, with the band's number in it."""
    low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        part = (short[at : at + 512, None] ^ _TURNS) * _FACTORS
        part ^= part >> np.uint32(15)
        np.minimum(low, part.min(axis=0), out=low)
    code = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        code = _mixed(code * _PRIME + column.astype(np.uint64))
    return code.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [cells(shingle_set(t.as_py(), shingle_words)) for t in batch.column("text")]
        flat = pa.array(np.concatenate(made) if made else np.zeros(0, np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * BANDS, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), lists], ["doc_id", "body", "cells"])


def _sets(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingle_set(t.as_py(), shingle_words) for t in batch.column("text")]
        cell = pa.array([np.append(cells(s), c) for s, c in zip(made, batch.column("class_cell").to_pylist(), strict=True)], pa.list_(pa.int64()))
        held = pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("body"), batch.column("root"), cell, held], ["body", "root", "cells", "held"])


class _Block:
    """The filed sets of one block of a candidate class, with the classes found so far."""

    def __init__(self, similarity: float):
        self.similarity, self.body, self.held, self.label, self.at = similarity, [], [], np.zeros(64, np.int64), {}

    def alike(self, held: np.ndarray, rows: np.ndarray) -> np.ndarray:
        sets = [self.held[i] for i in rows.tolist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets)
        found = held[np.minimum(np.searchsorted(held, flat), len(held) - 1)] == flat
        both = np.add.reduceat(found, np.cumsum(sizes) - sizes, dtype=np.int64)
        return both >= self.similarity * (sizes + len(held) - both) - 1e-9

    def links(self, held: np.ndarray, cell: list[int]) -> list[int]:
        """The rows that the set is linked to, one of each class; those classes become one."""
        met = [self.at[c] for c in cell if c in self.at]
        rows = np.unique(np.concatenate([np.array(m, np.int64) for m in met])) if met else np.zeros(0, np.int64)
        found, step = [], 1
        while len(rows):
            near = rows[:step][self.alike(held, rows[:step])]
            rows, step = rows[step:], min(step * 2, 64)
            for i in near.tolist():
                if not found or self.label[i] != self.label[found[0]]:
                    found.append(i)
                    self.label[: len(self.body)][self.label[: len(self.body)] == self.label[i]] = self.label[found[0]]
            if found and len(rows):
                rows = rows[self.label[rows] != self.label[found[0]]]
        return found

    def file(self, body: int, held: np.ndarray, cell: list[int], found: list[int]) -> None:
        i = len(self.body)
        if i == len(self.label):
            self.label = np.concatenate((self.label, np.zeros(i, np.int64)))
        self.label[i] = self.label[found[0]] if found else i
        self.body.append(body)
        self.held.append(held)
        for c in cell:
            self.at.setdefault(c, []).append(i)


def _compare(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (root, block, probe): links each set with the filed ones before it in its block."""
    key, block = None, _Block(similarity)
    for batch in batches:
        a, b = [], []
        at = [batch.column(c).to_pylist() for c in ("root", "block", "probe", "body", "cells")]
        held = batch.column("held")
        for i, (root, number, probe, body, cell) in enumerate(zip(*at, strict=True)):
            if key != (root, number):
                key, block = (root, number), _Block(similarity)
            mine = held[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
            found = block.links(mine, cell)
            a += [body] * len(found)
            b += [block.body[j] for j in found]
            if not probe:
                block.file(body, mine.copy(), cell, found)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _alike(a: str, b: str, similarity: float) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both >= similarity * (F.size(a) + F.size(b) - both) - 1e-9


def _by_cell(members: DataFrame, sets: DataFrame, similarity: float, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """(body, cell, near) -> rows to place, keyed by cell, and the links (a, b) found on the way.

    Cells of one text or of near texts only need no comparison, and of cells with the same texts one is kept. A cell of more than ``block_rows`` texts has a pivot of its own, unless
    most of its texts are near already.
    """
    sized = members.groupBy("cell").agg(
        F.count("*").alias("total"), F.count_if(~F.col("near")).alias("rest"), F.min(F.when(~F.col("near"), F.col("body"))).alias("pivot"),
        F.expr("bit_xor(xxhash64(body))").alias("x"), F.expr("bit_xor(xxhash64(body, 1))").alias("y"),
    )
    same = sized.where("total > 1 AND rest > 0").groupBy("total", "x", "y").agg(F.min(F.struct("cell", "rest", "pivot")).alias("kept"))
    kept = staged(same.select("total", "kept.*"), "nearcopies-kept")
    inside = staged(members.join(kept, "cell"), "nearcopies-inside")
    own = (F.col("total") > block_rows) & (F.col("rest") * 2 > F.col("total"))
    pivots = staged(kept.where(own).select("cell", F.col("pivot").alias("body")).join(sets.select("body", F.col("held").alias("pivot_held")), "body").select("cell", "pivot_held"), "nearcopies-cell-pivots")
    again = inside.where(own).join(sets.select("body", "held"), "body").join(pivots, "cell").select("cell", "body", "pivot", "total", _alike("held", "pivot_held", similarity).alias("near"))
    again = staged(again, "nearcopies-cell-near")
    linked = again.where("near AND body <> pivot").select(F.col("body").alias("a"), F.col("pivot").alias("b"))
    left = again.groupBy("cell").agg(F.count_if(~F.col("near")).alias("rest"))
    settled = again.join(left, "cell").select("cell", "near", "rest", "total", "body")
    rows = inside.where(~own).select("cell", "near", "rest", "total", "body").unionByName(settled).where("rest > 0")
    return rows.join(sets.select("body", "cells", "held"), "body").withColumnRenamed("cell", "root"), linked


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """(root, near, rest, total, body, cells, held) -> (root, block, probe, body, cells, held).

    The texts that are not near are dealt into blocks, where each is filed once; it passes by the blocks before its own, and near texts pass by all. What passes by a
    block is dealt into lanes, and each lane holds the block's filed sets, so no task reads a root of very many texts. A total of 0 is a root of one block and one lane.
    """
    blocks, lanes = F.ceil(F.col("rest") / block_rows).cast("long"), F.greatest(F.ceil(F.col("total") / block_rows).cast("long"), F.lit(1).cast("long"))
    home = F.when(F.col("near"), blocks).when(blocks > 0, F.pmod(F.xxhash64("body"), blocks)).otherwise(0)
    dealt = rows.withColumn("lanes", lanes).withColumn("home", home).withColumn("last", F.when(F.col("near"), blocks - 1).otherwise(F.col("home"))).where("last >= 0")
    met = dealt.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).withColumn("probe", F.expr("if(at = home, 0, 1)"))
    lane = F.when(F.col("probe") == 0, F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1)).otherwise(F.array(F.pmod(F.xxhash64("body", F.lit(1)), F.col("lanes"))))
    return met.withColumn("lane", F.explode(lane)).select("root", (F.col("at") * F.col("lanes") + F.col("lane")).alias("block"), "probe", "body", "cells", "held")


def links(texts: DataFrame, sketch: DataFrame, shingle_words: int = 5, similarity: float = 0.8, block_rows: int = 512) -> DataFrame:
    """(doc_id, body, text), (body, first_id, cells) with distinct bodies, the SimHash class's cell last, -> (a, b): links whose classes are those of all compared pairs that reach ``similarity``."""
    grid = sketch.select("body", F.explode("cells").alias("cell"))
    met = grid.groupBy("cell").agg(F.min("body").alias("least"), F.max("body").alias("most")).where("least < most")
    candidates = components(grid.join(staged(met.select("cell", "least"), "nearcopies-cells"), "cell").select(F.col("body").alias("a"), F.col("least").alias("b")))
    member = staged(candidates.unionByName(candidates.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "body"), "nearcopies-candidates")
    held = member.join(sketch.select("body", F.element_at("cells", -1).alias("class_cell"), "first_id"), "body").withColumnRenamed("body", "same")
    # of a text's copies the one with the smallest id is fetched: by id and text, so copies do not meet in a task
    one = (F.col("body") == F.col("same")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    wanted = texts.join(held, one).dropDuplicates(["body"]).select("body", "root", "class_cell", "text")
    sets = staged(wanted.mapInArrow(lambda it: _sets(it, shingle_words), "body long, root long, cells array<long>, held array<long>"), "nearcopies-sets")
    hot = staged(member.groupBy("root").count().where(F.col("count") > block_rows).select("root"), "nearcopies-hot")
    columns = ["root", "near", "rest", "total", "body", "cells", "held"]
    # a small class is one block of texts that are all filed
    placed, pivoted = sets.select("root", F.lit(False).alias("near"), F.lit(0).cast("long").alias("rest"), F.lit(0).cast("long").alias("total"), "body", "cells", "held"), None
    if not hot.isEmpty():
        pivot = sets.where("body = root").join(hot, "root").select("root", F.col("held").alias("pivot"))
        told = staged(sets.join(pivot, "root").select("body", "root", _alike("held", "pivot", similarity).alias("near")), "nearcopies-pivot")
        pivoted = told.where("near AND body <> root").select(F.col("body").alias("a"), F.col("root").alias("b"))
        counts = staged(told.groupBy("root").agg(F.count_if(~F.col("near")).alias("rest"), F.count("*").alias("total")), "nearcopies-blocks")
        # a text passes by every block, or stands in each of its cells: with more blocks than cells a class is cut by its cells
        wide = counts.where(F.ceil(F.col("rest") / block_rows) > BANDS + 1).select("root", F.lit(True).alias("wide"))
        spread = sets.join(told.select("body", "near"), "body", "left").join(counts.join(wide, "root", "left"), "root", "left").where("wide IS NULL")
        placed = spread.select("root", F.coalesce("near", F.lit(False)).alias("near"), F.coalesce("rest", F.lit(0)).alias("rest"), F.coalesce("total", F.lit(0)).alias("total"), "body", "cells", "held")
        in_cells = staged(grid.join(told.join(wide, "root").select("body", "near"), "body"), "nearcopies-wide")
        filed, linked = _by_cell(in_cells, sets, similarity, block_rows)
        placed, pivoted = placed.unionByName(filed.select(*columns)), pivoted.unionByName(linked)
    placed = _blocks(placed, block_rows)
    dealt = placed.repartition("root", "block").sortWithinPartitions("root", "block", "probe")
    found = dealt.mapInArrow(lambda it: _compare(it, similarity), "a long, b long")
    return found.unionByName(pivoted) if pivoted is not None else found


def near_copies(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, block_rows: int = 512, radius: int = 3) -> tuple[DataFrame, DataFrame]:
    """documents -> (doc_id, body), one row per input row, and (body, class, component_id), one per distinct text.

    body is the text's hash, class the smallest body of its class, component_id the smallest doc_id of the class (null ids take no part).
    Texts without a word are one class. Repeated rows and null ids are rows like others; other columns are not read. No rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("body"), "text")
    owned = staged(texts.mapInArrow(lambda it: _sketch(it, shingle_words), "doc_id long, body long, cells array<long>"), "nearcopies-sketch")
    prints = simhash.near_duplicates(docs.select(F.xxhash64("text").alias("doc_id"), "text"), shingle_words, radius)
    prints = staged(prints.groupBy(F.col("doc_id").alias("body")).agg(F.min(F.xxhash64("class_fp", F.lit(BANDS))).alias("class_cell")), "nearcopies-prints")
    firsts = owned.groupBy("body").agg(F.min("doc_id").alias("first_id"), F.min("cells").alias("cells")).join(prints, "body")
    distinct = staged(firsts.select("body", "first_id", F.array_append("cells", F.col("class_cell")).alias("cells")), "nearcopies-distinct")
    member = components(links(texts, distinct, shingle_words, similarity, block_rows)).withColumnRenamed("node", "body")
    named = staged(distinct.join(member, "body", "left").select("body", "first_id", F.coalesce("root", "body").alias("class")), "nearcopies-named")
    least = named.groupBy("class").agg(F.min("first_id").alias("component_id"))
    return owned.select("doc_id", "body"), staged(named.join(least, "class").select("body", "class", "component_id"), "nearcopies-classes")
