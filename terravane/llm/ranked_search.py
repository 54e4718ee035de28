"""Ranked lexical search through hierarchical max trees over document ranges.

Documents are read once: each is counted, and its counts of the words that any query asks are
kept as a row. The asked words reach the readers as a filter of fixed size in the plan; what
passes it wrongly finds no query later, so it costs time and never a result. Rows
are dealt into ranges of about ``range_docs`` documents. In a range, every term has a tree: its leaves
are the term's exact parts of the documents' scores, an inner node is the largest
below it, over ``FAN`` children each. Trees of all terms lie side by side, sorted by node, so
that the summed bounds of a node's children are one slice.

A query descends best first: the node with the highest summed bound is opened next, from a
heap; a document's leaf gives its exact score. It ends when no bound reaches the score of the k-th
document found; nodes whose bound equals it are opened too, as they may hold
a tie with a smaller id. Each range gives its k best for each query, and those of all ranges
are ranked by a window that Spark cuts to k rows a query before it shuffles.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged

FAN = 16
FILTER_WORDS = 1 << 14  # 64-bit words of the filter: 128 KB whatever the number of queries
QUERY_TERMS = 200_000  # a block of queries has about so many terms

# letters, digits and all bytes beyond ASCII stay, A-Z become small, the rest parts terms
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, only A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _spots(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms)) % np.uint64(FILTER_WORDS * 64)


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, text) -> (item_id, term) distinct; rows of one item_id are one item, a null item_id too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t.as_py()))) for t in batch.column("text")]
            lengths = np.array([len(x) for x in found])
            flat = [t.decode("utf-8", "surrogatepass") for x in found for t in x]
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(np.repeat(np.arange(len(found)), lengths))), pa.array(flat, pa.string())], ["item_id", "term"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item_id long, term string").distinct()


def asked_filter(asked: DataFrame) -> np.ndarray:
    """The filter's words: a bit for the hash of every term; at most ``FILTER_WORDS`` numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            spots = _spots([t.encode("utf-8", "surrogatepass") for t in batch.column("term").to_pylist()])
            np.bitwise_or.at(words, (spots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spots & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["at", "bits"])

    rows = asked.select("term").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).collect()
    words = np.zeros(FILTER_WORDS, np.int64)
    for row in rows:
        words[row["at"]] = row["bits"]
    return words.view(np.uint64)


def counted(docs: DataFrame, asked: np.ndarray) -> DataFrame:
    """documents -> (doc_id, n, terms, tfs, mark): n counts all terms with repeats, the lists hold those that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, tfs, cuts, marks = [], [], [], [0], []
            for value, origin in zip(batch.column("text"), batch.column("origin").to_pylist(), strict=True):
                counts = Counter(terms_of(value.as_py()))
                found = list(counts)
                spots = _spots(found)
                passed = np.flatnonzero(asked[(spots >> np.uint64(6)).astype(np.int64)] >> (spots & np.uint64(63)) & np.uint64(1)).tolist()
                sizes.append(counts.total())
                flat += [found[i].decode("utf-8", "surrogatepass") for i in passed]
                tfs += [counts[found[i]] for i in passed]
                cuts.append(len(flat))
                marks.append(xxhash.xxh64_intdigest(str(origin)) >> 1)
            cuts = pa.array(cuts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(flat, pa.string())), pa.ListArray.from_arrays(cuts, pa.array(tfs, pa.int64())), pa.array(marks, pa.int64())],
                ["doc_id", "n", "terms", "tfs", "mark"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("origin"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<string>, tfs array<long>, mark long")


class MaxTrees:
    """The trees of all terms over one range. Level 0 holds documents; a level is its entries (term, bound), sorted by node, and the cuts between nodes."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, part: np.ndarray, n_docs: int):
        order = np.lexsort((term, doc))
        term, node, bound, n = term[order], doc[order], part[order], n_docs
        self.levels = [(term, bound, np.searchsorted(node, np.arange(n + 1)))]
        while n > 1:
            node, n = node // FAN, -(-n // FAN)
            order = np.lexsort((term, node))
            node, term, bound = node[order], term[order], bound[order]
            heads = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])))) if len(node) else np.zeros(0, np.int64)
            node, term, bound = node[heads], term[heads], np.maximum.reduceat(bound, heads) if len(heads) else bound
            self.levels.append((term, bound, np.searchsorted(node, np.arange(n + 1))))

    def sums(self, level: int, low: int, high: int, asked: np.ndarray) -> np.ndarray:
        """Summed bounds of nodes low to high, of the terms marked in ``asked``."""
        term, bound, cuts = self.levels[level]
        edges = cuts[low : high + 1]
        run = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.where(asked[term[edges[0] : edges[-1]]], bound[edges[0] : edges[-1]], 0))))
        return np.diff(run[edges - edges[0]])

    def best(self, asked: np.ndarray, k: int, ids: list) -> list[tuple[int, int]]:
        """(score, document) of the k best above 0; equal scores by ``ids``, which are in order."""
        top = len(self.levels) - 1
        heap = [(-int(b), top, i) for i, b in enumerate(self.sums(top, 0, len(self.levels[top][2]) - 1, asked)) if b > 0]
        heapq.heapify(heap)
        found: list[tuple[int, int]] = []  # the worst of the k best first: (score, -document)
        while heap and (len(found) < k or -heap[0][0] >= found[0][0]):
            bound, level, node = heapq.heappop(heap)
            if level == 0:
                (heapq.heappush if len(found) < k else heapq.heappushpop)(found, (-bound, -node))
                continue
            below, low = level - 1, node * FAN
            high = min(low + FAN, len(self.levels[below][2]) - 1)
            for i, b in enumerate(self.sums(below, low, high, asked).tolist()):
                if b > 0 and (len(found) < k or b >= found[0][0]):
                    heapq.heappush(heap, (-b, below, low + i))
        return sorted(((s, -d) for s, d in found), key=lambda x: (-x[0], x[1]))


def _search(left: pa.Table, right: pa.Table, k: int, documents: int, length: int) -> pa.Table:
    """One range of documents against one block of queries."""
    if not left.num_rows or not right.num_rows:
        return _FOUND.empty_table()
    left = left.sort_by([("doc_id", "ascending")])  # null ids last; the order of documents is that of ties
    vocabulary = pc.unique(right.column("term").combine_chunks())
    lists = left.column("terms").combine_chunks()
    asked = pc.index_in(lists.flatten(), value_set=vocabulary).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(left.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    at = np.flatnonzero(~np.isnan(asked)) if asked.dtype.kind == "f" else np.arange(len(asked))
    term, doc = asked[at].astype(np.int64), doc[at]
    tf = left.column("tfs").combine_chunks().flatten().to_numpy()[at]
    m = 10 + (90 * left.column("n").to_numpy() * documents) // max(length, 1)
    weight = np.zeros(len(vocabulary), np.int64)
    asked_at = pc.index_in(right.column("term").combine_chunks(), value_set=vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    weight[asked_at] = right.column("weight").to_numpy()
    trees = MaxTrees(term, doc, weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])), left.num_rows)
    ids = left.column("doc_id").to_pylist()
    order = np.argsort(right.column("item").to_numpy(), kind="stable")
    item, asked_at = right.column("item").to_numpy()[order], asked_at[order]
    items = right.column("item_id").take(pa.array(order)).to_pylist()
    heads = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
    rows: list[tuple] = []
    wants = np.zeros(len(vocabulary), bool)
    for a, b in zip(heads, np.append(heads[1:], len(item)), strict=True):
        wants[asked_at[a:b]] = True
        rows += [(items[a], ids[d], s) for s, d in trees.best(wants, k, ids)]
        wants[asked_at[a:b]] = False
    return pa.table([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else ((), (), ()))], schema=_FOUND)


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def search(docs: DataFrame, items: DataFrame, k: int = 10, range_docs: int = 4096, range_terms: int = 1 << 19) -> DataFrame:
    """documents x items -> (item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), its part of a document's score w * (10^9 tf div (1000 tf + 8m)) with
    m = 10 + 90nN div L. N counts documents with a term, L their terms, n a document's, all over whole texts.
    Null and empty texts have no term: such documents are found by no item and such items find none. Rows repeated under
    one doc_id are documents of their own, each with its rank; a null doc_id comes last among equal scores. Rows of one item_id are one
    item. Other columns are not read. Without documents or items there are no rows.

    Ranges have about ``range_docs`` documents and ``range_terms`` counts, so a task's memory does not grow with the tables. Queries are
    dealt into blocks of about ``QUERY_TERMS`` terms; each range meets each block once.
    """
    asked = staged(query_terms(items), "search-asked")
    found = staged(counted(docs, asked_filter(asked)), "search-counted")
    stats = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length"), F.count("*").alias("rows"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("counts")).first()
    documents, length = stats["documents"], stats["length"]
    ranges = max(1, -(-stats["rows"] // range_docs), -(-stats["counts"] // range_terms))
    held = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = staged(
        asked.join(held, "term").select("item_id", "term", F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("weight")), "search-weights"
    )
    blocks = max(1, -(-weighed.count() // QUERY_TERMS))
    number = F.coalesce(F.xxhash64("item_id"), F.lit(0))
    queries = weighed.select(
        "item_id", number.alias("item"), "term", "weight", F.pmod(number, F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("range")
    )
    rows = found.where(F.size("terms") > 0).select(
        "doc_id", "n", "terms", "tfs", F.pmod("mark", F.lit(ranges)).cast("int").alias("range"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    best = rows.groupBy("range", "block").cogroup(queries.groupBy("range", "block")).applyInArrow(
        lambda left, right: _search(left, right, k, documents, length), "item_id long, doc_id long, score long"
    )
    by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
