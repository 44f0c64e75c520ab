"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates and queries are dealt into blocks, and every pair of blocks is one
task of bounded size. A task sorts its candidates by each dimension once. For a
query it walks all lists downwards in the direction of the query's sign,
scores what it meets for the first time, and stops when even a vector that
stood at the reached place of every list could not beat the kth best score
(or tie with it). The blocks' answers are merged by a window per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 1024
#: places of every list that the first step takes; each further step doubles the depth
FIRST_DEPTH = 16

RESULT = "query_id bigint, vec_id bigint, score bigint"


def usable(vector: Column) -> Column:
    """Is the vector not null and free of null and non-finite components?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, in double precision."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


class SortedLists:
    """A block's vectors and, by dimension, their indices in ascending order of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # ties then fall to the smaller id
        self.ids, self.vectors = ids[order], vectors[order]
        self.up = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.down = self.up[:, ::-1].copy()

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Indices and scores of the k best but ``own``; the depth where the walk stopped."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        q = query[dims]
        lists = np.where((q > 0)[:, None], self.down[dims], self.up[dims])
        seen = self.ids == own
        best, score = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        at, step = 0, FIRST_DEPTH
        while at < n:
            end = min(n, at + step) if len(dims) else n
            new = np.zeros(n, dtype=bool)
            new[lists[:, at:end] if len(dims) else slice(None)] = True
            new &= ~seen
            seen |= new
            found = np.flatnonzero(new)
            best = np.concatenate([best, found])
            score = np.concatenate([score, self.vectors[found] @ query])
            if len(best) > k:
                keep = np.lexsort((best, -score))[:k]
                best, score = best[keep], score[keep]
            at, step = end, end
            if len(best) == k and at < n:
                bound = (q * self.vectors[lists[:, at - 1], dims]).sum()
                if bound < score.min():
                    break
        return best, score, at


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in col.chunks]).to_numpy(zero_copy_only=False)
    m = flat.reshape(len(col), -1)
    top = float(np.abs(m).max()) if m.size else 0.0
    # products and sums are exact in doubles up to 2**53; beyond it Python's integers
    return m.astype(np.float64) if top * top * max(1, m.shape[1]) < 2 ** 53 else m.astype(object)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vector_col: str = "vector") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query.

    Both tables hold an id and an array of integers. A row is compared with
    every row of the same length but those with its own id; equal scores go to
    the smaller id; fewer than k candidates give all of them. Rows whose id or
    vector is null, or whose vector holds a null, take no part; repeated
    candidate rows each count; of query rows that share an id the least vector counts,
    once. Empty tables
    give no rows. Other columns are left out.
    """
    def clean(df: DataFrame) -> DataFrame:
        d = df.select(F.col(id_col).cast("bigint").alias("id"),
                      F.col(vector_col).cast("array<bigint>").alias("v"))
        return d.where("id is not null and v is not null").where(
            ~F.exists("v", lambda x: x.isNull())).withColumn("dim", F.size("v"))

    c = clean(vectors)
    q = clean(queries).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n_c = max(1, -(-c.count() // CANDIDATE_BLOCK))
    n_q = max(1, -(-q.count() // QUERY_BLOCK))
    c = c.withColumn("cb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_c))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_q - 1).cast("bigint"))))
    q = q.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_q))).withColumn(
        "cb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_c - 1).cast("bigint"))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            block = SortedLists(left.column("id").to_numpy(), _matrix(left.column("v")))
            for own, query in zip(right.column("id").to_pylist(), _matrix(right.column("v")),
                                  strict=True):
                best, score, _ = block.top(query.astype(block.vectors.dtype), own, k)
                out += [(own, int(block.ids[b]), int(s))
                        for b, s in zip(best, score, strict=True)]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(
            ("query_id", "vec_id", "score"), cols, strict=True)})

    keys = ["dim", "cb", "qb"]
    found = c.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(meet, RESULT)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
