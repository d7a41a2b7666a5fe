"""Hard negatives by Kronecker-packed products: rows close to an anchor, but of another label and clearly below a positive.

The components of several candidates in one dimension are raised by a common bias, so none is negative, and set side by side
into separated fields of one wide integer. An anchor multiplies that integer once per dimension by its own component and adds
up; each field then holds one candidate's inner product, raised by a known amount. An offset that was added to every
field keeps partial sums from borrowing from the next one, and the width of a field follows from the largest components, so
fields never overlap and the scores are exact whole numbers.

Two passes over the cells (see `cells`): the first finds each anchor's positives, the second, which then knows the score band of
each positive, the best rows of other labels within it. A cell returns at most `count` rows for each band, and rows in several bands once.

Rows with a null id or label and vectors that are null, empty, or hold null or non-finite components take no part. Only vectors of
equal length are compared. Ties go to the smaller id. A repeated row is a candidate as often as it occurs (as a positive too), a
repeated anchor is one anchor, and an id with several vectors or labels is an anchor with each; no row with the anchor's id is
its positive or negative. A score beyond a long is an error, as in Spark's own arithmetic. An empty table, an anchor without
positives and a positive whose band is empty give no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.cells import Queries, answered, whole_numbers
from keepwell.session import stored


class PackedProducts:
    """Candidates' components in the fields of one wide integer per dimension."""

    def __init__(self, vectors: np.ndarray, largest: int):
        """`largest`: no component of an anchor exceeds it in size."""
        self.count, width = vectors.shape
        self.bias = int(max(-vectors.min(), 0))
        raised = int(vectors.max()) + self.bias
        reach = width * max(largest, 1) * max(raised, 1)  # no partial sum of raised products exceeds it in size
        self.bytes = 4 if 2 * reach < 1 << 32 else 8 if 2 * reach < 1 << 64 else (2 * reach).bit_length() // 8 + 1
        self.offset = reach
        self.offsets = self._packed([reach] * self.count)
        self.packed = [self._packed([int(x) + self.bias for x in vectors[:, d]]) if self.bytes > 8 or abs(vectors[:, d]).max() >= 1 << 53
                       else self._packed(vectors[:, d].astype(np.int64) + self.bias) for d in range(width)]

    def _packed(self, fields) -> int:
        if self.bytes > 8:
            return int.from_bytes(b"".join(int(x).to_bytes(self.bytes, "little") for x in fields), "little")
        return int.from_bytes(np.asarray(fields, f"<u{self.bytes}").tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of `anchor` with every candidate."""
        total = self.offsets
        for component, packed in zip(anchor, self.packed, strict=True):
            if component:
                total += component * packed
        raw, extra = total.to_bytes(self.count * self.bytes, "little"), self.offset + self.bias * sum(anchor)
        if self.bytes > 8:
            return np.array([int.from_bytes(raw[i:i + self.bytes], "little") - extra for i in range(0, len(raw), self.bytes)], object)
        if self.bytes == 8:
            return np.array([x - extra for x in np.frombuffer(raw, "<u8").tolist()], object)
        return np.frombuffer(raw, "<u4").astype(np.int64) - extra


def _first(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the `count` highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > count:
        kth = np.partition(scores, len(scores) - count)[len(scores) - count]
        at = np.flatnonzero(scores >= kth)
    return at[np.lexsort((ids[at], -scores[at]))[:count]]


class PackedSearch:
    """Offers rows to the anchors of a cell; what `pick(i, same, scores, ids)` chooses of them is kept for anchor i."""

    def __init__(self, queries: Queries):
        self.queries = queries
        self.anchors = [[int(x) for x in row] for row in queries.matrix]
        self.largest = max(abs(x) for row in self.anchors for x in row)
        self.ids = [np.zeros(0, np.int64) for _ in self.anchors]
        self.scores = [np.zeros(0, np.int64) for _ in self.anchors]

    def offer(self, ids: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        packed = PackedProducts(vectors, self.largest)
        names, kind = np.unique(np.array(labels, object), return_inverse=True)
        place = {name: i for i, name in enumerate(names.tolist())}
        for i, anchor in enumerate(self.anchors):
            use = self.eligible(kind == place.get(self.queries.label[i], -1)) & (ids != self.queries.id[i])
            scores = np.concatenate([self.scores[i], packed.scores(anchor)[use]])
            found = np.concatenate([self.ids[i], ids[use]])
            best = self.pick(i, scores, found)
            self.ids[i], self.scores[i] = found[best], scores[best]

    def answers(self) -> tuple[list[int], list[int], list[int]]:
        rows = [row for row, found in zip(self.queries.row, self.ids, strict=True) for _ in found]
        return rows, [int(x) for found in self.ids for x in found], [int(x) for found in self.scores for x in found]


class Positives(PackedSearch):
    """The first `count` rows of the anchor's label."""

    def __init__(self, queries: Queries, count: int):
        super().__init__(queries)
        self.count = count

    def eligible(self, same: np.ndarray) -> np.ndarray:
        return same

    def pick(self, i: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return _first(scores, ids, self.count)


class Negatives(PackedSearch):
    """The first `count` rows of other labels in the band of each of the anchor's positives, whose scores are the `marks`."""

    def __init__(self, queries: Queries, count: int, low: int, high: int):
        super().__init__(queries)
        self.count = count
        # low * p <= 100 * s <= high * p for whole s
        self.bands = [sorted({(-(-low * p // 100), high * p // 100) for p in marks}) for marks in queries.marks]

    def eligible(self, same: np.ndarray) -> np.ndarray:
        return ~same

    def pick(self, i: int, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(scores), bool)
        for least, most in self.bands[i]:
            within = np.flatnonzero((scores >= least) & (scores <= most))
            kept[within[_first(scores[within], ids[within], self.count)]] = True
        return np.flatnonzero(kept)


def hard_negatives(vectors: DataFrame, asked: str, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256,
                   positives: int = 5, count: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors: rows whose `id` satisfies `asked`.

    For each of the first `positives` rows of the anchor's label, the first `count` rows of other labels whose score is
    at least `low` and at most `high` percent of the positive's.
    """
    points = whole_numbers(vectors.where(label.isNotNull()), id_col, vector_col, scale, label)
    anchors = stored(points.where(asked).groupBy("id", "vector", "label", "width").agg(F.min("row").alias("row")), "anchors")

    near = answered(points, anchors.withColumn("marks", F.lit(None)), lambda q: Positives(q, positives))
    by_score = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    near = stored(near.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
                  .select("row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    marked = anchors.join(near.groupBy("row").agg(F.collect_set("positive_score").alias("marks")), "row")
    far = answered(points, marked, lambda q: Negatives(q, count, low, high))
    exact = {name: F.col(f"{name}_score").cast("decimal(24,0)") for name in ("positive", "negative")}
    pairs = near.join(far.select("row", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), "row").where(
        (exact["negative"] * 100).between(exact["positive"] * low, exact["positive"] * high))
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return (pairs.withColumn("rank", rank).where(F.col("rank") <= count)
            .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
