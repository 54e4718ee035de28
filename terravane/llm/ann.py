"""Nearest neighbours from randomly rotated one-bit codes.

A vector is centred on the mean, normalised and rotated by a seeded random orthogonal matrix; its code is the sign bit of each
coordinate. With the correction scalar c = <code / sqrt(d), rotated unit vector>, the inner product of the unit vector and a
query is estimated as <code / sqrt(d), rotated query> / c, and the estimate errs by more than
``epsilon * |query| * sqrt((1 - c^2) / c^2 / (d - 1))`` only with a probability that falls exponentially in ``epsilon``.
The rotated query is rounded to ``query_bits`` bits a coordinate and kept as bit planes, so <code, query> is a sum of
popcounts of packed words; the rounding's exact error is added to the bound. From estimate and bound come a lower and an upper bound of each distance.

Vectors and queries are dealt into blocks by the hash of their row; each pair of blocks is one task of bounded size that returns
k rows a query, and a second, small step merges them. In a task the vectors of the least upper bounds are measured first; then all
whose lower bound is no greater than the k-th distance among these. Every vector has a code and is compared with every query.
Vectors travel once for each block of ``query_rows`` queries. On evenly spread vectors one bit a coordinate leaves a large part of them within the bounds
(of 64 dimensions a third at epsilon 3), so sending originals for picked pairs only would move more than the blocks do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vec, dims) without null ids and vectors that are null, empty, zero or hold null or non-finite components."""
    vec = F.col(embedding)
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vec.cast("array<double>").alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
        .where(~F.coalesce(bad_of(F.col("vec")), F.lit(False)) & F.exists("vec", lambda x: x != 0))
        .withColumn("dims", F.size("vec"))
    )


def bad_of(vec: Column) -> Column:
    return F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def means(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each number of dimensions; one number a dimension comes to the driver, whatever the rows."""
    found = rows.select("dims", F.posexplode("vec").alias("pos", "x")).groupBy("dims", "pos").agg(F.avg("x").alias("mean")).collect()
    out = {d: np.zeros(d) for d in {r.dims for r in found}}
    for r in found:
        out[r.dims][r.pos] = r.mean
    return out


def words_of(bits: np.ndarray) -> np.ndarray:
    """(n, d) booleans -> (n, ceil(d / 64)) packed words."""
    packed = np.packbits(bits, axis=1)
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def turned_units(vecs: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the centre, and the rotated unit vectors from it."""
    rest = vecs - centre
    norm = np.linalg.norm(rest, axis=1)
    return norm, rest / np.where(norm > 0, norm, 1)[:, None] @ turn


def encode(vecs: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the centre and correction scalar of each vector."""
    norm, turned = turned_units(vecs, centre, turn)
    correction = np.where(norm > 0, np.abs(turned).sum(axis=1) / np.sqrt(vecs.shape[1]), 1.0)
    return words_of(turned > 0), norm, correction


def planes(vecs: np.ndarray, centre: np.ndarray, turn: np.ndarray, query_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, query_bits, words) bit planes of the rounded rotated queries, and (n, 5) scalars: distance to the centre, least value, step, sum of the rounded values, sum of the rounding errors."""
    size, turned = turned_units(vecs, centre, turn)
    low = turned.min(axis=1)
    step = np.maximum(turned.max(axis=1) - low, 1e-300) / (2**query_bits - 1)
    level = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, 2**query_bits - 1)
    rounded = low[:, None] + step[:, None] * level
    out = np.stack([words_of((level.astype(np.int64) >> b) & 1 == 1) for b in range(query_bits)], axis=1)
    return out, np.stack([size, low, step, rounded.sum(axis=1), np.abs(turned - rounded).sum(axis=1)], axis=1)


def bounds(codes: np.ndarray, norm: np.ndarray, correction: np.ndarray, query: np.ndarray, scalars: np.ndarray, dims: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of one query from all codes, by popcounts and scalars alone."""
    size, low, step, total, rounding = scalars
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    weighed = np.zeros(len(codes), np.int64)
    for b, plane in enumerate(query):
        weighed += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << b
    # signs are twice the bits less one
    inner = (2 * (low * ones + step * weighed) - total) / np.sqrt(dims) / correction
    error = epsilon * np.sqrt(np.maximum(1 - correction**2, 0) / correction**2 / max(dims - 1, 1)) + rounding / np.sqrt(dims) / correction
    base = norm**2 + size**2
    half = 2 * norm * size * error + 1e-9 * base + 1e-12
    mid = base - 2 * norm * size * inner
    # where squares overflow nothing is known
    return np.where(np.isfinite(mid), mid - half, -np.inf), np.where(np.isfinite(mid), mid + half, np.inf)


def _distances(vecs: np.ndarray, query: np.ndarray) -> np.ndarray:
    total = np.zeros(len(vecs))
    for j in range(vecs.shape[1]):  # in order of the components, whatever the number of vectors
        total += (vecs[:, j] - query[j]) ** 2
    return np.sqrt(total)


def _matrix(table: pa.Table, name: str, at: np.ndarray) -> np.ndarray:
    """Rows ``at`` of a column of equally long lists."""
    return table.column(name).take(pa.array(at)).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)


def nearest(codes: np.ndarray, norm: np.ndarray, correction: np.ndarray, vecs: np.ndarray, ids: np.ndarray, plane: np.ndarray, scalars: np.ndarray, query: np.ndarray, own: int | None, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """vec_ids and distances of a query's k nearest in a block; ``own`` is the query's place in the block, if it stands there."""
    low, high = bounds(codes, norm, correction, plane, scalars, vecs.shape[1], epsilon)
    if own is not None:
        low[own] = high[own] = np.inf
    left = len(ids) - (own is not None)
    if left <= k:
        pick = np.flatnonzero(np.arange(len(ids)) != (-1 if own is None else own))
    else:
        first = np.argpartition(high, min(4 * k, left) - 1)[: min(4 * k, left)]
        if own is not None:
            first = first[first != own]
        limit = np.partition(_distances(vecs[first], query), k - 1)[k - 1]
        with np.errstate(over="ignore"):
            near = low <= limit * limit * (1 + 1e-9) + 1e-300
        if own is not None:
            near[own] = False
        pick = np.flatnonzero(near)
    score = _distances(vecs[pick], query)
    order = np.lexsort((ids[pick], score))[:k]
    return ids[pick[order]], score[order]


def search(
    vectors: DataFrame, queries: Column, k: int = 10, epsilon: float = 3.0, seed: int = 7, block_rows: int = 8192, query_rows: int = 16384, query_bits: int = 5
) -> DataFrame:
    """(vec_id, vec, dims) of ``usable`` -> (query_id, rank, vec_id, score): the k nearest of each row for which ``queries`` holds.

    score is the Euclidean distance in double precision; ties go to the smaller vec_id. A query's own row is no
    candidate, every other row is: rows that repeat a vec_id are candidates and, where ``queries`` holds, queries of their own. Vectors are
    compared with queries of as many dimensions. Fewer candidates than k give as many ranks. Null ids are left out by ``usable``, and other columns are not read. No rows give no rows.
    """
    rows = staged(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec", "dims", F.coalesce(queries, F.lit(False)).alias("asks")), "ann-vectors")
    centres = means(rows)
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-asked // query_rows))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, g in pdf.groupby("dims"):
                turn = turns.setdefault(d, rotation(d, seed))
                codes, norm, correction = encode(np.stack(g["vec"].to_numpy()), centres[d], turn)
                yield g.assign(code=[c.tobytes() for c in codes], norm=norm, correction=correction)

    def planed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turns: dict[int, np.ndarray] = {}
        for pdf in batches:
            for d, g in pdf.groupby("dims"):
                turn = turns.setdefault(d, rotation(d, seed))
                bits, scalars = planes(np.stack(g["vec"].to_numpy()), centres[d], turn, query_bits)
                yield g.assign(planes=[b.tobytes() for b in bits], scalars=list(scalars))

    base = "row long, vec_id long, vec array<double>, dims int"
    bare = rows.select("row", "vec_id", "vec", "dims")
    filed = staged(bare.mapInPandas(coded, f"{base}, code binary, norm double, correction double"), "ann-codes")
    asking = staged(rows.where("asks").select("row", "vec_id", "vec", "dims").mapInPandas(planed, f"{base}, planes binary, scalars array<double>"), "ann-queries")
    home = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = filed.withColumn("block", home(blocks)).withColumn("query_block", every(query_blocks)).groupBy("query_block", "block")
    asks = asking.withColumn("query_block", home(query_blocks)).withColumn("block", every(blocks)).groupBy("query_block", "block")

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        dims, query_dims = left["dims"].to_numpy(), right["dims"].to_numpy()
        for d in np.unique(query_dims).tolist():
            here, there = np.flatnonzero(dims == d), np.flatnonzero(query_dims == d)
            if not len(here):
                continue
            vecs, query, scalars = _matrix(left, "vec", here), _matrix(right, "vec", there), _matrix(right, "scalars", there)
            codes = np.frombuffer(b"".join(left["code"].take(pa.array(here)).to_pylist()), np.uint64).reshape(len(here), -1)
            bits = np.frombuffer(b"".join(right["planes"].take(pa.array(there)).to_pylist()), np.uint64).reshape(len(there), query_bits, -1)
            row, ids, norm, correction = (left[c].to_numpy()[here] for c in ("row", "vec_id", "norm", "correction"))
            asker, query_id = (right[c].to_numpy()[there] for c in ("row", "vec_id"))
            place = dict(zip(row.tolist(), range(len(row)), strict=True))
            for j in range(len(there)):
                found, score = nearest(codes, norm, correction, vecs, ids, bits[j], scalars[j], query[j], place.get(int(asker[j])), k, epsilon)
                out.append((np.full(len(found), asker[j]), np.full(len(found), query_id[j]), found, score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["asker", "query_id", "vec_id", "score"])

    found = dealt.cogroup(asks).applyInArrow(meet, "asker long, query_id long, vec_id long, score double")
    order = Window.partitionBy("asker").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
