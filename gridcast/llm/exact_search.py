"""Exact top-k search by inner product with a pivot table.

Every vector keeps its distances to `PIVOTS` pivot vectors. By the triangle inequality the distance between a query and
a candidate is at least the greatest difference of their pivot distances, and as
q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, that bounds the score from above. A query takes its candidates in the order of
these bounds and stops when the next bound is below its k-th best score; equal bounds are still looked at, as a tie may
have a smaller id. Bounds are widened by more than the rounding error of the distances, so the result is exact.

Queries and candidates are cut into blocks by a hash of the id, each pair of blocks is one task's work, and each block
gives its k best; a window over those picks the k best of a query. Neither side is broadcast. Pivots are picked far
apart from a bounded sample (`SAMPLE`); they steer the speed only.

Components become floor(1024 * x) of the double. Vectors that are null, hold a null or a value that isn't finite, or
have a null id take no part. Rows equal in id and vector count once; rows of one id with other vectors are queries of
their own and no candidates of each other. Shorter vectors count as padded with zeros. Scores beyond a long count as
the nearest long, also where they are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 32
SAMPLE = 2000
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
STEP = 512  # candidates looked at between two checks of the bound
SCALE = 1024
LONG = np.iinfo(np.int64)


def vectors_of(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (whole numbers as doubles), n: the rows that take part, and how many are alike in both."""
    wide = F.col(vector).cast("array<double>")
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col(key).isNotNull() & wide.isNotNull() & fine)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.transform(wide, _floor).alias("v")).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))


def _floor(x):
    """floor(SCALE * x) as a double. Spark's floor gives a long, so large values, which are whole anyway, stay as they are."""
    scaled = x * SCALE
    return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.asarray(lists.offsets)
    flat = np.asarray(lists.values)
    size = np.diff(ends)
    if len(size) and (size == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    for i, (a, n) in enumerate(zip(ends[:-1].tolist(), size.tolist())):
        out[i, :n] = flat[a : a + n]
    return out


def _far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows of the sample, each as far as can be from those before it."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample**2).sum(1)))]
    away = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < n and away.max() > 0:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(pivots)))
    for k, p in enumerate(pivots):
        out[:, k] = np.sqrt(((x - p) ** 2).sum(1))
    return out


def _scores(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:  # every sum stays below 2**53
        return (x @ q).astype(np.int64)
    whole = [int(a) for a in q]
    sums = [sum(int(a) * b for a, b in zip(row, whole)) for row in x]
    return np.array([min(max(s, LONG.min), LONG.max) for s in sums], np.int64)


def _search(queries: pa.Table, candidates: pa.Table, width: int, pivots: int, k: int) -> pa.Table:
    out: list[tuple[int, int, int, int]] = []
    if queries.num_rows and candidates.num_rows:
        q, x = _matrix(queries.column("v"), width), _matrix(candidates.column("v"), width)
        dq, dx = (_matrix(t.column("p"), pivots) for t in (queries, candidates))
        qid, xid = queries.column("vec_id").to_numpy(), candidates.column("vec_id").to_numpy()
        of = queries.column("version").to_numpy()
        qq, xx = (q**2).sum(1), (x**2).sum(1)
        largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width
        exact = bool(largest < 2**53)
        for i in range(len(q)):
            apart = np.zeros(len(x))
            for j in range(dx.shape[1]):
                np.maximum(apart, np.abs(dx[:, j] - dq[i, j]), out=apart)
            slack = 1e-9 * (qq[i] + xx) + 1
            bound = (qq[i] + xx - apart**2) / 2 + slack
            order = np.argsort(-bound, kind="stable")
            best_s, best_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for a in range(0, len(order), STEP):
                part = order[a : a + STEP]
                if len(best_s) == k and bound[part[0]] < best_s[-1]:
                    break
                part = part[xid[part] != qid[i]]
                s, n = np.r_[best_s, _scores(x[part], q[i], exact)], np.r_[best_i, xid[part]]
                keep = np.lexsort((n, ~s))[:k]  # ~s falls as s rises, and can't overflow
                best_s, best_i = s[keep], n[keep]
            out += [(int(qid[i]), int(of[i]), int(n), int(s)) for n, s in zip(best_i, best_s)]
    names = ("query_id", "version", "vec_id", "score")
    return pa.table({n: pa.array([r[j] for r in out], pa.int64()) for j, n in enumerate(names)})


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """For each row of `queries` its k best of `vectors`, itself left out: query_id, rank, vec_id, score.

    Both as `vectors_of` gives them. Ties go to the smaller id; with fewer than k candidates all are returned. Every row is
    a candidate: a vector that n rows have can take n of the k places. A query that several rows ask is answered once.
    """
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    n_queries = queries.count()
    width = max(1, int(width), int(queries.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]))
    drawn = vectors.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).toArrow()
    far = _far_apart(_matrix(drawn.column("v"), width), pivots) if drawn.num_rows else np.zeros((1, width))

    def table(batches):
        for b in batches:
            d = _distances(_matrix(b.column("v"), width), far)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * d.shape[1]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.ListArray.from_arrays(ends, d.ravel())], names=["vec_id", "v", "p"])

    with_pivots = lambda df: df.select("vec_id", "v").mapInArrow(table, "vec_id long, v array<double>, p array<double>")
    q_blocks, c_blocks = max(1, -(-n_queries // query_block)), max(1, -(-n // candidate_block))
    at = lambda blocks: F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = with_pivots(queries).select("vec_id", "v", "p", F.xxhash64("v").alias("version"), at(q_blocks).alias("qb"), each(c_blocks).alias("cb"))
    # Of rows alike no more than k can be among the k best.
    every = vectors.select("vec_id", "v", F.explode(F.array_repeat(F.lit(0), F.least("n", F.lit(k)).cast("int"))))
    right = with_pivots(every).select("vec_id", "v", "p", at(c_blocks).alias("cb"), each(q_blocks).alias("qb"))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(lambda a, b: _search(a, b, width, len(far), k), "query_id long, version long, vec_id long, score long")
    order = Window.partitionBy("query_id", "version").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
