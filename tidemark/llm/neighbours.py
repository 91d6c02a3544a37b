"""Approximate nearest neighbours by collision-counting, query-aware hashing.

Largest inner product becomes least distance by one more coordinate that gives all vectors the same
norm.  Each of ``TABLES`` random projections is one sorted array of vectors.  A query's window in it is centred on the query's own
projection; virtual rehashing widens the windows of all arrays together, and only the rows that a window gains are read and
counted.  Vectors with ``THRESHOLD`` collisions or more are verified by the exact product on the original vectors.

When to stop follows from the hash family: a vector at distance ``d`` collides in a window of half-width ``w`` with the
probability that a normal variable of deviation ``d`` stays within ``w``.  A query ends once its windows are so wide that a vector as
far as the ``k``-th best verified one would have reached the threshold with probability ``SURE`` (nearer ones more surely), or
hold everything.  So the share of vectors verified follows the data: few where neighbours stand out, many where they hardly do.

Vectors are dealt into blocks of about ``BLOCK``, the stated queries into blocks of ``QUERIES``; a task builds the arrays of one
block, and the best of each block are merged.
"""

from __future__ import annotations

from math import erf, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

TABLES, THRESHOLD, WIDEN, SURE = 128, 51, 1.3, 0.88
BLOCK, QUERIES, SEED = 8_192, 4_096, 7


def _reach() -> float:
    """Half-width of a window, as a multiple of a distance, at which the threshold is reached with probability ``SURE``."""
    z, x = NormalDist().inv_cdf(SURE), 0.0
    while (p := erf(x / sqrt(2))) * TABLES - z * sqrt(TABLES * p * (1 - p)) < THRESHOLD - 0.5:
        x += 1e-3
    return x


REACH = _reach()


class Index:
    """Sorted arrays of one block of vectors."""

    def __init__(self, vectors: np.ndarray, norm: float, seed: int = SEED) -> None:
        self.vectors, self.norm = vectors, norm
        rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", vectors, vectors), 0))
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, TABLES))
        values = np.ascontiguousarray((np.hstack([vectors, rest[:, None]]) @ self.lines).T)
        self.order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, self.order, axis=1)

    def nearest(self, queries: np.ndarray, k: int, ids: np.ndarray, own: np.ndarray, start: float) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For each query rows and scores of the verified vectors, all that may be among its ``k`` best, and the width that would have done; ``start`` is the first width."""
        n, m = len(self.vectors), len(queries)
        lengths = np.linalg.norm(queries, axis=1)
        centres = (queries * (self.norm / lengths)[:, None] @ self.lines[:-1]).T  # the query's own length does not matter
        low = high = np.stack([row.searchsorted(c) for row, c in zip(self.values, centres, strict=True)])
        width, enough = np.full(m, start), np.full(m, start)
        counts, verified = np.zeros((m, n), np.uint8), np.zeros((m, n), bool)
        rows, scores = [np.empty(0, np.int64)] * m, [np.empty(0)] * m
        active = np.arange(m)
        while len(active):
            at, reach = centres[:, active], width[active]
            a = np.minimum(low[:, active], np.stack([row.searchsorted(c) for row, c in zip(self.values, at - reach, strict=True)]))
            b = np.maximum(high[:, active], np.stack([row.searchsorted(c, side="right") for row, c in zip(self.values, at + reach, strict=True)]))
            going = np.zeros(m, bool)
            for j, i in enumerate(active.tolist()):
                ends = (a[:, j].tolist(), low[:, i].tolist(), high[:, i].tolist(), b[:, j].tolist())
                gained = [row[x:y] for row, x, y in zip(self.order, *ends[:2], strict=True) if x < y] + [row[x:y] for row, x, y in zip(self.order, *ends[2:], strict=True) if x < y]
                if gained:
                    counts[i] += np.bincount(np.concatenate(gained), minlength=n).astype(np.uint8)
                new = np.flatnonzero((counts[i] >= THRESHOLD) & ~verified[i])
                verified[i, new] = True
                new = new[ids[new] != own[i]]
                rows[i], scores[i] = np.append(rows[i], new), np.append(scores[i], self.vectors[new] @ queries[i])
                wanted = np.inf
                if len(rows[i]) >= k:
                    best = np.partition(scores[i], len(rows[i]) - k)[len(rows[i]) - k]
                    wanted = REACH * sqrt(max(0.0, 2 * self.norm * (self.norm - best / lengths[i])))
                enough[i] = min(wanted, width[i])
                going[i] = wanted > width[i] and (a[:, j].any() or (b[:, j] < n).any())
                width[i] = min(wanted, width[i] * WIDEN)
            low, high = low.copy(), high.copy()
            low[:, active], high[:, active] = a, b
            active = np.flatnonzero(going)
        return rows, scores, enough


def search(index: Index, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, neighbour and score of the ``k`` best of this block for each query; equal scores go by the smaller id."""
    out = ([], [], [])
    tried = np.linspace(0, len(queries) - 1, min(len(queries), 8)).astype(int)
    first = REACH * index.norm  # as for neighbours at 60 degrees
    first = float(np.median(index.nearest(queries[tried], k, ids, query_ids[tried], first)[2]))  # where the others begin
    for at in range(0, len(queries), 256):
        own = query_ids[at : at + 256]
        for i, found, score in zip(own, *index.nearest(queries[at : at + 256], k, ids, own, first)[:2], strict=True):
            if len(score) > k:
                some = score >= np.partition(score, len(score) - k)[len(score) - k]
                found, score = found[some], score[some]
            best = np.lexsort((ids[found], -score))[:k]
            out[0].append(np.full(len(best), i))
            out[1].append(ids[found[best]])
            out[2].append(score[best])
    return tuple(np.concatenate(c) if c else np.empty(0) for c in out)


def _pair(k: int):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        left = left.sort_values("_id", kind="stable")
        index = Index(np.array(left["_v"].tolist(), np.float64), float(left["_norm"].iloc[0]))
        found = search(index, left["_id"].to_numpy(), np.array(right["_v"].tolist(), np.float64), right["_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": found[0].astype("int64"), "vec_id": found[1].astype("int64"), "score": found[2]})

    return run


def nearest(vectors: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row for which ``is_query`` holds, among all other rows.

    Vectors that are null, zero, or hold nulls or values that are not finite take no part, nor do null ids.  Vectors are compared with those of
    their own length, for others have no inner product with them.  Ids are taken as unique (of repeated ids the rows stay
    candidates); fewer candidates than ``k`` are all given; an empty table gives no rows; other columns are read by ``is_query`` only.
    """
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), values.alias("_v"), F.expr(is_query).alias("_q"))
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("_v", lambda x: x != 0)
    rows = written(rows.where(fine).withColumn("_n", F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)).withColumn("_d", F.size("_v")), "vectors")
    long = lambda c: F.greatest(F.lit(1), F.floor(c)).cast("long")
    sizes = rows.groupBy(F.col("_d").alias("_e")).agg(long(F.count("*") / block).alias("_blocks"), long(F.count_if("_q") / queries).alias("_parts"), F.sqrt(F.max("_n")).alias("_norm"))
    sized = rows.join(sizes, F.col("_d") == F.col("_e"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = sized.select("_id", "_v", "_norm", "_d", F.pmod(F.xxhash64("_id"), "_blocks").alias("_b"), upto("_parts").alias("_p"))
    right = sized.where("_q").select("_id", "_v", "_d", F.pmod(F.xxhash64("_id", F.lit(1)), "_parts").alias("_p"), upto("_blocks").alias("_b"))
    left, right = left.toDF("_id", "_v", "_norm", "_d", "_b", "_p"), right.toDF("_id", "_v", "_d", "_p", "_b")
    found = left.groupBy("_d", "_b", "_p").cogroup(right.groupBy("_d", "_b", "_p")).applyInPandas(_pair(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
