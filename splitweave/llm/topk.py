"""Exact top-k by inner product: pivot-table elimination.

Inner products become distances: with M the largest norm, a vector x gets one more component sqrt(M² − |x|²) and a query
a zero, so |q − x|² = M² + |q|² − 2 q·x, and the highest products are the nearest vectors. Every vector keeps its distances
to many pivots; by the triangle inequality max over pivots |d(q,p) − d(x,p)| bounds d(q,x) from below. A task takes one
block of vectors and one block of queries, evaluates a query's candidates in the order of their bounds and stops as soon
as the next bound exceeds the k-th distance found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splitweave.llm.common import written

SLACK = 1e-7  # relative; floating-point bounds are loosened by it, scores are exact integers
CHUNK = 128


def dots(x: np.ndarray, q: np.ndarray, largest: int) -> np.ndarray:
    """Exact integer products of rows and one query; beyond 64 bits the result is cut to the range of a long."""
    bound = max(1, x.shape[1]) * largest * largest
    if bound < 1 << 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return x @ q
    exact = x.astype(object) @ q.astype(object)
    return np.array([min(max(int(v), -(1 << 63)), (1 << 63) - 1) for v in exact], np.int64)


def matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def pivot_set(sample: np.ndarray, pivots: int, top: float) -> np.ndarray:
    """Farthest-first pivots of a sample, with the extra component."""
    x = lifted(sample, top)
    if not len(x):
        return x
    chosen = [int(np.argmax((x * x).sum(1)))]
    far = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(x)):
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    f = x.astype(np.float64)
    return np.c_[f, np.sqrt(np.maximum(0, top - (f * f).sum(1)))]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T)))


def top_k(
    vectors: DataFrame, queries: Callable[[Column], Column], k: int = 5, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256,
    pivots: int = 16, sample: int = 1024, block: int = 4096, query_block: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query with all other vectors.

    Components become ``floor(scale * x)``. ``queries`` gives, for the id column, the condition that makes a row a query. Ties go to the smaller id; fewer than
    ``k`` rows come back where there are fewer vectors. Vectors that are null or hold a null or non-finite component, and
    rows without an id, take no part. A repeated id counts once, with its largest vector. Shorter vectors count as
    padded with zeros. An empty table gives no rows. Other columns are ignored.

    Pivots and first thresholds come from a sample of ``sample`` vectors (those with the smallest hash of the id); all
    vectors are searched. ``block`` and ``query_block`` bound what a task holds.
    """
    spark = vectors.sparkSession
    whole = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    base = vectors.select(F.col(id_column).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v")).where(F.col("_id").isNotNull() & F.col("_v").isNotNull() & whole)
    base = base.select("_id", F.transform("_v", lambda x: F.floor(x * F.lit(float(scale)))).alias("_v")).groupBy("_id").agg(F.max("_v").alias("_v"))
    base = written(base.select("_id", "_v", F.coalesce(queries(F.col("_id")), F.lit(False)).alias("_q")), "vectors")
    norm = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    largest = F.aggregate("_v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(F.greatest(x, F.lit(-(2**63 - 1))))))
    n, nq, width, top, large = base.agg(F.count("*"), F.count_if("_q"), F.max(F.size("_v")), F.max(norm), F.max(largest)).first()
    width, top, large = width or 0, top or 0.0, large or 0
    picked = base.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id", "_v").collect()
    ids = np.array([r[0] for r in picked], np.int64)
    seen = matrix([r[1] for r in picked], width)
    table = pivot_set(seen, pivots, top)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("_v").to_pylist(), width)
            d, dq = distances(lifted(x, top), table), distances(np.c_[x.astype(np.float64), np.zeros(len(x))], table)
            floor = []
            for i, own, asks in zip(range(len(x)), b.column("_id").to_pylist(), b.column("_q").to_pylist(), strict=True):
                s = dots(seen[ids != own], x[i], large) if asks else ids[:0]
                floor.append(int(np.partition(s, len(s) - k)[len(s) - k]) if len(s) >= k else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_v"), b.column("_q"), pa.array(list(d), pa.list_(pa.float64())), pa.array(list(dq), pa.list_(pa.float64())), pa.array(floor, pa.int64())],
                ["_id", "_v", "_q", "_d", "_dq", "_floor"],
            )

    blocks, query_blocks = max(1, math.ceil(n / block)), max(1, math.ceil(nq / query_block))
    measured = written(base.mapInArrow(measure, "_id long, _v array<long>, _q boolean, _d array<double>, _dq array<double>, _floor long"), "pivots")
    part = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asked = measured.where("_q").select("_id", "_v", F.col("_dq").alias("_d"), "_floor", part("_id", query_blocks).alias("_qb"), every(blocks).alias("_b"))
    held = measured.select("_id", "_v", "_d", part("_id", blocks).alias("_b"), every(query_blocks).alias("_qb"))

    def search(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(q) and len(x):
            xid, xv, xd = x["_id"].to_numpy(np.int64), matrix(list(x["_v"]), width), np.array(list(x["_d"]), np.float64).reshape(len(x), -1)
            for own, v, d, floor in zip(q["_id"], matrix(list(q["_v"]), width), q["_d"], q["_floor"], strict=True):
                found = nearest(xid, xv, xd, int(own), v, np.asarray(d, np.float64), None if pd.isna(floor) else int(floor), k, top, large)
                out.append((np.full(len(found[0]), own, np.int64), *found))
        parts = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
        return pd.DataFrame({"query_id": parts[0], "vec_id": parts[1], "score": parts[2]})

    found = asked.groupBy("_qb", "_b").cogroup(held.groupBy("_qb", "_b")).applyInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(xid, xv, xd, own, v, d, floor, k, top, large) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of one block for one query: (ids, scores). ``floor``: a score that ``k`` other vectors are known to reach."""
    bound = np.abs(xd - d).max(axis=1) if xd.shape[1] else np.zeros(len(xid))
    norm = float((v.astype(np.float64) ** 2).sum())
    slack = SLACK * (math.sqrt(top) + math.sqrt(norm) + 1)
    reach = lambda s: math.sqrt(max(0.0, top + norm - 2.0 * s)) * (1 + SLACK) + slack
    left = np.flatnonzero(xid != own)
    if floor is not None:
        left = left[bound[left] <= reach(floor)]
    left = left[np.argsort(bound[left], kind="stable")]
    ids, scores = xid[:0], xid[:0]
    for at in range(0, len(left), CHUNK):
        if len(scores) == k and bound[left[at]] > reach(int(scores[-1])):
            break
        take = left[at : at + CHUNK]
        ids, scores = np.r_[ids, xid[take]], np.r_[scores, dots(xv[take], v, large)]
        best = np.lexsort((ids, ~scores))[:k]
        ids, scores = ids[best], scores[best]
    return ids, scores
