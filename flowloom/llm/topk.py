"""Exact top-k inner products by aggregation without random access.

Queries and candidates are dealt into a grid of bounded blocks, as many as their counts ask for. Within a cell every
dimension is a list sorted by value. A query reads the lists from their best ends in step, keeps what each candidate has
collected so far, a lower bound (the worst value for each unread dimension) and an upper bound (the value that each
list has come to), and stops once no candidate outside the k best can still enter. Only then are the scores of these k
resolved. Candidates that no bound can part, as ties, are read to the end. The cells' winners are merged by a window per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries and candidates of a grid cell, about.
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
#: Shares of the lists that are read before each look at the bounds.
LOOKS = (1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 15 / 16, 1)

RESULT = "query_id long, vec_id long, score long"


def whole_components(df: DataFrame, scale: int = 1024, vector: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) of each component; vectors that are or hold null, NaN or infinite go."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce((c == c) & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull() & fine)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * float(scale)).cast("long")).alias("v"))


def no_random_access(query: np.ndarray, values: np.ndarray, order: np.ndarray, k: int, barred: np.ndarray, lists: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the k best candidates for a query and of those tied with them, scores exact.

    ``values`` is dimension by candidate, ``order`` sorts each dimension and ``lists`` are the values in that order,
    ``barred`` marks candidates that don't count. All candidates tied with the k-th score are among the result. Scores
    and bounds must stay below 2 ** 53.
    """
    n = values.shape[1]
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    if not len(up) + len(down) or n <= k:
        rows = np.flatnonzero(~barred)
        return rows, query @ values[:, rows]
    lists = np.take_along_axis(values, order, axis=1) if lists is None else lists
    # A list is read from its best end: from the largest value down for a positive weight, else from the smallest up.
    used = np.concatenate([up, down])
    weights = query[used].astype("f8")
    worst = np.concatenate([query[up] * lists[up, 0], query[down] * lists[down, -1]]).astype("f8")
    partial, unread_worst = np.zeros(n), np.full(n, worst.sum())
    unread = np.ones((len(used), n))  # 1 or 0
    places = (np.arange(len(used)) * n)[:, None]
    begin, open_rows = 0, np.flatnonzero(~barred)
    for share in LOOKS:
        end = max(begin + 1, int(n * share))
        ids = np.concatenate([order[up, n - end : n - begin], order[down, begin:end]])
        read = np.concatenate([lists[up, n - end : n - begin], lists[down, begin:end]]) * weights[:, None]
        partial += np.bincount(ids.ravel(), read.ravel(), n)
        unread_worst -= np.bincount(ids.ravel(), np.repeat(worst, end - begin), n)
        unread.ravel()[(ids + places).ravel()] = 0
        frontier = np.concatenate([query[up] * lists[up, n - end], query[down] * lists[down, end - 1]])
        lower = partial + unread_worst
        lower[barred] = -np.inf
        least = np.partition(lower, n - k)[n - k]  # the k-th best lower bound
        # What is unread of a list can't be better than where reading has come to. Bounds of k rise, so what is shut out stays.
        open_rows = open_rows[(partial + frontier @ unread)[open_rows] >= least]
        begin = end
        if len(open_rows) <= k or end >= n:
            break
    return open_rows, query @ values[:, open_rows]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` candidates with the largest inner product for each query.

    Both tables are (vec_id, v) with whole components of one dimension. Ties go to the smaller ``vec_id``; a candidate
    with the query's ``vec_id`` is the query itself and left out. Queries that repeat an id count once, with the
    smallest vector; repeated candidates are rows of their own. With fewer candidates all are returned, with none or
    no query no rows. Vectors whose scores may exceed 64 bits are an error. Further columns are left out.
    """
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n_q, n_c = queries.count(), candidates.count()
    q_blocks, c_blocks = max(1, -(-n_q // QUERY_BLOCK)), max(1, -(-n_c // CANDIDATE_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")
    # Rows with equal ids and vectors are dealt by position, so that no block is all copies.
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(c_blocks)).cast("int")
    left = queries.withColumn("qb", block).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = candidates.withColumn("cb", dealt).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table["v"].combine_chunks()
        ids = table["vec_id"].to_numpy()
        sizes = set(lists.value_lengths().to_pylist())
        if len(sizes) > 1:
            raise ValueError("vectors must have one dimension")
        return ids, np.asarray(lists.flatten(), "i8").reshape(len(ids), sizes.pop())

    def cell(asked: pa.Table, there: pa.Table) -> pa.Table:
        out = [[], [], []]
        if asked.num_rows and there.num_rows:
            q_ids, q_rows = matrix(asked)
            ids, rows = matrix(there)
            if q_rows.shape[1] != rows.shape[1]:
                raise ValueError("vectors must have one dimension")
            # The largest score that these could have; beyond 53 bits bounds in doubles are not exact, so all count then.
            largest = rows.shape[1] * int(np.abs(q_rows).max(initial=0)) * int(np.abs(rows).max(initial=0))
            if largest >= 1 << 63:
                raise ValueError("scores may exceed 64 bits")
            exact = largest < 1 << 53
            values = np.ascontiguousarray(rows.T)
            order = np.argsort(values, axis=1, kind="stable")
            lists = np.take_along_axis(values, order, axis=1)
            for q_id, query in zip(q_ids, q_rows, strict=True):
                if exact:
                    found, scores = no_random_access(query, values, order, k, ids == q_id, lists)
                else:
                    found = np.flatnonzero(ids != q_id)
                    scores = rows[found] @ query
                best = np.lexsort((ids[found], -scores))[:k]
                out[0].append(np.full(len(best), q_id))
                out[1].append(ids[found[best]])
                out[2].append(scores[best])
        columns = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(cell, RESULT)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
