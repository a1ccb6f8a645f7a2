"""Nearest neighbours by largest inner product: a block matrix join.

Queries and candidates are dealt into blocks; a tile is a block of queries against a block of candidates. In a
tile, vectors are quantised to int8 with one scale each, and a matrix product of the codes gives approximate
products. With the quantisation errors' lengths e, |product - approximate| <= e_q |c| + |q'| e_c (q' the decoded
query), so a candidate whose upper bound lies below the query's k-th best lower bound is out. The surviving
pairs are computed anew in double precision, dimension by dimension, and the tile keeps k per query; tiles are
merged by a heap per query. Nothing is approximate in the result.

Equal vectors of a block are multiplied once, and k + 1 of their ids are enough (ties go to smaller ids).

Defined cases. Null, empty or zero vectors, vectors with null or non-finite components, and null ids take no
part. An id that repeats counts once, with its smallest vector. Vectors meet only vectors of their length.
Fewer than k candidates: all of them. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

K = 20
QUERY_ROWS = 1024
CANDIDATE_ROWS = 4096
#: Codes up to 127: sums of so many products are exact in float32.
EXACT_TERMS = 1024
PAIRS_AT_ONCE = 1 << 19


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns id and vector of the rows that take part, one per id."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where("id IS NOT NULL AND vector IS NOT NULL").where(finite & F.exists("vector", lambda x: x != 0))
            .groupBy("id").agg(F.min("vector").alias("vector")))


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, lengths of the vectors, of their decoded forms and of the errors."""
    scale = np.abs(x).max(1) / 127
    codes = np.rint(x / scale[:, None])
    decoded = codes * scale[:, None]
    return codes.astype(np.int8), scale, *[np.sqrt((v * v).sum(1)) for v in (x, decoded, x - decoded)]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT_TERMS):
        out += a[:, d:d + EXACT_TERMS].astype(np.float32) @ b[:, d:d + EXACT_TERMS].astype(np.float32).T
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, product): the k nearest of the block for each query."""
    c, which = np.unique(c, axis=0, return_inverse=True)
    order = np.lexsort((c_ids, which.ravel()))
    ids_of = [ids[:k + 1].tolist() for ids in np.split(c_ids[order], np.cumsum(np.bincount(which.ravel()))[:-1])]
    q_codes, q_scale, _, q_decoded, q_error = _quantised(q)
    c_codes, c_scale, c_length, _, c_error = _quantised(c)
    near = _products(q_codes, c_codes) * q_scale[:, None] * c_scale
    slack = (q_error[:, None] * c_length + q_decoded[:, None] * c_error) * (1 + 1e-9) + 1e-12 * (q_decoded + q_error)[:, None] * c_length
    # k + 1, as one of them may be the query itself.
    floor = np.partition(near - slack, len(c) - k - 1, axis=1)[:, len(c) - k - 1] if len(c) > k + 1 else np.full(len(q), -np.inf)
    rows, columns = np.nonzero(near + slack >= floor[:, None])
    scores = np.empty(len(rows))
    for low in range(0, len(rows), PAIRS_AT_ONCE):
        i, j = rows[low:low + PAIRS_AT_ONCE], columns[low:low + PAIRS_AT_ONCE]
        total = np.zeros(len(i))
        for d in range(q.shape[1]):
            total += q[i, d] * c[j, d]
        scores[low:low + PAIRS_AT_ONCE] = total
    out = []
    cuts = np.searchsorted(rows, np.arange(len(q) + 1))
    for n, own in enumerate(q_ids.tolist()):
        found = ((-s, i) for s, j in zip(scores[cuts[n]:cuts[n + 1]].tolist(), columns[cuts[n]:cuts[n + 1]].tolist())
                 for i in ids_of[j] if i != own)
        out += [(own, i, -s) for s, i in heapq.nsmallest(k, found)]
    return out


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K, query_rows: int = QUERY_ROWS,
            candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """queries, candidates: as usable() returns them, ids long. Columns query_id, rank (from 1), vec_id, score."""
    across = math.ceil(queries.count() / query_rows) or 1
    down = math.ceil(candidates.count() / candidate_rows) or 1

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        at: Column = F.pmod(F.xxhash64("id"), F.lit(n).cast("long"))
        # Names of their own: both sides may come from one table.
        side = own[0]
        return rows.select(F.col("id").alias(f"{side}_id"), F.col("vector").alias(f"{side}_vector"), F.size("vector").alias("dim"), at.alias(own),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other))

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            rows = tile(left["q_id"].to_numpy(), _matrix(left["q_vector"]), right["c_id"].to_numpy(), _matrix(right["c_vector"]), k)
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    def merge(group: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip((-s for s in group["score"].to_pylist()), group["vec_id"].to_pylist()))
        n = len(best)
        return pa.table({"query_id": group["query_id"].combine_chunks()[:n] if n else pa.array([], pa.int64()),
                         "rank": pa.array(range(1, n + 1), pa.int32()),
                         "vec_id": pa.array([i for _, i in best], pa.int64()), "score": pa.array([-s for s, _ in best], pa.float64())})

    keys = ["dim", "q_block", "c_block"]
    tiles = (dealt(queries, "q_block", across, "c_block", down).groupBy(*keys)
             .cogroup(dealt(candidates, "c_block", down, "q_block", across).groupBy(*keys))
             .applyInArrow(multiply, "query_id long, vec_id long, score double"))
    return tiles.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
