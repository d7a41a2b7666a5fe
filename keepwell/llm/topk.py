"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Every batch of vectors is sorted once per dimension. A query walks all lists at one depth, each from the end where its own
component makes the product largest, and scores a vector in full the first time a list shows it. The products at the depth
reached add up to a bound on every vector not yet seen. The walk ends when that bound is below the k-th best score (at equality
an unseen vector with a smaller id could still win), or when no vector is unseen. The k best carry over from batch to batch,
so later batches start with a bound to beat and may end at depth zero.

The walk goes in steps of doubling depth, so the work per step is a few array operations. On vectors whose components are
independent (random directions) the bound falls slowly and nearly all vectors are seen before it ends; the result is exact
in any case. `answered` in `cells` says how vectors and queries meet.

Scores are exact: sums of whole numbers below 2^53, and Python integers where they could be larger (a score beyond a long is an
error, as in Spark's own arithmetic). Vectors that are null, empty, or hold null or non-finite components, and rows with a null
id, take no part. Only vectors of equal length are compared. Ties go to the smaller id. A repeated row is a candidate as often as
it occurs, a repeated query is asked once, and an id with several vectors is asked with each; no row with the query's id
is its candidate. An empty table gives an empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.cells import Queries, answered, whole_numbers

EXACT = 2.0**53


def exact_numbers(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where no inner product of their rows can reach 2^53, else as Python integers."""
    if a.shape[1] * max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) < EXACT:
        return a, b
    return tuple(np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))


class ThresholdSearch:
    """The k best vectors of each query of a cell."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.ids = [np.zeros(0, np.int64) for _ in range(len(queries))]
        self.scores = [np.zeros(0) for _ in range(len(queries))]

    def offer(self, ids: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        asked, vectors = exact_numbers(self.queries.matrix, vectors)
        lists = np.argsort(vectors.T, axis=1, kind="stable").astype(np.int32)  # a row per dimension, ascending
        values = np.take_along_axis(vectors.T, lists, axis=1)
        for i in range(len(self.queries)):
            self._walk(i, asked[i], ids, vectors, lists, values)

    def _walk(self, i: int, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, lists: np.ndarray, values: np.ndarray) -> None:
        n = len(ids)
        up = query > 0  # these lists are read from their upper end
        dims, order, unseen = np.flatnonzero(query != 0), np.arange(len(query)), ids != self.queries.id[i]
        depth, step = 0, max(1, n // 64)
        while depth < n:
            least = self.scores[i][-1] if len(self.scores[i]) == self.k else None
            bound = (query * values[order, np.where(up, n - 1 - depth, depth)]).sum()
            if (least is not None and bound < least) or not unseen.any():
                return
            end = min(n, depth + step)
            if len(dims):
                shown = np.zeros(n, bool)
                shown[lists[up, n - end:n - depth]] = True
                shown[lists[(query < 0), depth:end]] = True
                new = np.flatnonzero(shown & unseen)
            else:  # a query of zeros scores 0 with all
                new, end = np.flatnonzero(unseen), n
            unseen[new] = False
            self._keep(i, ids[new], vectors[new] @ query)
            depth, step = end, step * 2

    def _keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(self.scores[i]) == self.k:
            better = scores >= self.scores[i][-1]
            ids, scores = ids[better], scores[better]
        if len(scores) > self.k:  # all that tie with the k-th stay
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= kth], scores[scores >= kth]
        if len(ids):
            ids, scores = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
            best = np.lexsort((ids, -scores))[:self.k]
            self.ids[i], self.scores[i] = ids[best], scores[best]

    def answers(self) -> tuple[list[int], list[int], list[int]]:
        rows = [row for row, found in zip(self.queries.row, self.ids, strict=True) for _ in found]
        return rows, [int(x) for found in self.ids for x in found], [int(x) for found in self.scores for x in found]


def top_k(vectors: DataFrame, asked: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          scale: float = 1024) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of every row whose `id` satisfies the SQL condition `asked`."""
    points = whole_numbers(vectors, id_col, vector_col, scale)
    queries = points.where(asked).groupBy("id", "vector", "label", "width").agg(F.min("row").alias("row"))
    named = queries.select("row", F.col("id").alias("query_id"))
    found = answered(points, queries.withColumn("marks", F.lit(None)), lambda q: ThresholdSearch(q, k))
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    return best.join(named, "row").select("query_id", "rank", "id", "score")
