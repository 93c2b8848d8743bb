"""Exact top-k by inner product of quantised vectors.

Queries and candidates meet in a grid: candidates are dealt into tiles, queries
into groups, and a task gets one tile and one group, so that neither side is
broadcast and no pair is written.  In a tile vectors stand column by column;
for each query scores are summed a block of dimensions at a time, and only the
candidates stay whose partial score plus the largest rest that the remaining
mass of both vectors allows (Cauchy-Schwarz) can still reach the k-th best.

Defined results: vectors that are null or empty, or hold a null, NaN or infinite
component, take no part; vectors of different length are never compared; ties
go to the smaller id, equal rows may both be answers; if a query id is repeated
its smallest vector is the query, and rows of the same id are never its answers.
An empty table gives an empty frame.  Scaled components must stay below 2**31
for the scores to fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a tile and of a query group, dimensions of a block, candidates scored in full first.
TILE, GROUP, BLOCK, SEED = 65_536, 4_096, 8, 256
ANSWER = "query_id long, vec_id long, score long"


def valid(v: Column) -> Column:
    """Whether an array holds at least one component and only finite ones."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & fine, F.lit(False))


def quantised(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(column).cast("array<double>").alias("x"))
    own = own.where(F.col("id").isNotNull() & valid(F.col("x")))
    return own.select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"), F.size("x").alias("dims"))


def _matrix(t: pa.Table, dims: int) -> np.ndarray:
    return t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)


def best_in_tile(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """For each query the (positions, scores) of rows that may be among its k best."""
    dims = rows.shape[1]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * dims
    kind = np.float64 if largest < 2**53 else np.int64      # both sum exactly
    energy = (rows.astype(np.float64) ** 2).sum(0)
    order = np.argsort(-energy, kind="stable")               # heavy dimensions first
    upright = np.ascontiguousarray(rows[:, order].T.astype(kind))
    queries = queries[:, order].astype(kind)
    cuts = list(range(0, dims, BLOCK)) + [dims]
    left = np.zeros((len(cuts), len(rows)))                  # norm of each row from a block on
    for b in range(len(cuts) - 2, -1, -1):
        part = upright[cuts[b]:cuts[b + 1]].astype(np.float64)
        left[b] = left[b + 1] + (part * part).sum(0)
    left = np.sqrt(left)
    for q, own in zip(queries, query_ids):
        other = ids != own
        seed = np.flatnonzero(other[:SEED])
        full = np.sort(q @ upright[:, seed])
        least = full[-k] if len(full) >= k else -np.inf
        mass = np.sqrt(np.concatenate([np.cumsum((q.astype(np.float64) ** 2)[::-1])[::-1], [0.0]]))
        at, score = np.flatnonzero(other), None
        for b in range(len(cuts) - 1):
            block = upright[cuts[b]:cuts[b + 1]]
            more = q[cuts[b]:cuts[b + 1]] @ (block if len(at) == len(rows) else block[:, at])
            score = more if score is None else score + more
            rest = mass[cuts[b + 1]] * left[b + 1][at]
            if len(at) > k:   # the k-th largest score that is sure already raises the bar
                least = max(least, np.partition(score - rest * (1 + 1e-9), len(at) - k)[len(at) - k])
            stay = score + rest * (1 + 1e-9) + 1e-6 >= least
            if not stay.all():
                at, score = at[stay], score[stay]
        top = np.lexsort((ids[at], -score))[:k]
        yield int(own), at[top], score[top]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
          column: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score; `is_query` is a condition on the column `id`."""
    rows = quantised(vectors, id_col, column, scale)
    asked = rows.where(is_query).groupBy("id", "dims").agg(F.min("v").alias("v"))
    n, nq = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tiles = max(1, -(-n // TILE), min(2 * cores, n // 1024))
    groups = max(1, -(-nq // GROUP))
    one = F.sequence(F.lit(0), F.lit(groups - 1))
    each = F.sequence(F.lit(0), F.lit(tiles - 1))
    left = rows.select("id", "v", "dims", F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile"),
                       F.explode(one).alias("part"))
    right = asked.select("id", "v", "dims", F.explode(each).alias("tile"),
                         F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("part"))

    def search(key, tile: pa.Table, group: pa.Table) -> pa.Table:
        dims = key[2].as_py()
        out = ([], [], [])
        if tile.num_rows and group.num_rows:
            ids = tile.column("id").to_numpy()
            for own, at, score in best_in_tile(_matrix(group, dims), group.column("id").to_numpy(),
                                               _matrix(tile, dims), ids, k):
                out[0].extend([own] * len(at))
                out[1].extend(ids[at].tolist())
                out[2].extend(int(s) for s in score)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    keys = ("tile", "part", "dims")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, ANSWER)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
