"""Packed products, hard negatives and threshold search against brute force, with odd vectors, ties and repeats."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import cells, negatives, topk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, row int, vector int, score int, width int, rank int, marks int"


def table(spark, rows):
    """Vectors with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3, 4, 5, 6) for i, v, label in rows], SCHEMA)


def whole(v, scale):
    if not v or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(scale * x) for x in v]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def best(query, rows, k):
    """(score, id) of the k best of `rows`, (id, whole numbers), without the query's own id."""
    i, q = query
    found = [(-inner(q, v), j) for j, v in rows if j != i and len(v) == len(q)]
    return [(-s, j) for s, j in sorted(found)[:k]]


def odd_rows(seed, n=260, width=6):
    """Vectors with ties, exact copies, opposite, zero, huge, short, null and non-finite ones."""
    rng = random.Random(seed)
    some = [[rng.choice([-1, -.5, 0, .25, .5, 1]) * rng.random() for _ in range(width)] for _ in range(40)]
    rows = []
    for i in range(n):
        v = list(rng.choice(some)) if rng.random() < .5 else [rng.gauss(0, .4) for _ in range(width)]
        rows.append((i, [-x for x in v] if rng.random() < .1 else v, rng.randrange(4)))
    odd = [(300, None, 1), (400, [], 1), (500, [0.0] * width, 1), (600, [None] * width, 2), (700, [math.nan] * width, 1), (800, [math.inf] + [0.0] * (width - 1), 1),
           (None, rows[0][1], 1), (900, rows[0][1], None), (1000, [.5, -.5], 1), (1001, [.5, .5], 1), (1002, [.4, .5], 2), (1100, [3000.0] * width, 3)]
    return rows + odd


# ---------------------------------------------------------------- 13
def searched(spark, rows, **how):
    return topk.top_k(table(spark, rows), "id % 100 = 0", **how).collect()


@pytest.mark.parametrize(("seed", "k"), [(1, 10), (2, 3), (3, 400)])
def test_threshold_search_equals_brute_force(spark, seed, k):
    rows = odd_rows(seed)
    usable = [(i, w) for i, v, _ in rows if i is not None and (w := whole(v, 1024))]
    expect = {(i, r, j, s) for i, q in usable if i % 100 == 0 for r, (s, j) in enumerate(best((i, q), usable, k), 1)}
    got = searched(spark, rows, k=k)
    assert len(got) == len(expect)
    assert {(r.query_id, r["rank"], r.id, r.score) for r in got} == expect


def test_threshold_search_on_numbers_beyond_doubles(spark):
    rows = [(0, [2.0**20 + 1, 3.0], 1), (1, [2.0**20, 1.0], 1), (2, [2.0**20, 2.0], 1), (3, [2.0**20, 2.0], 1), (4, [-(2.0**20), 2.0], 1)]
    usable = [(i, whole(v, 2048)) for i, v, _ in rows]
    got = searched(spark, rows, k=4, scale=2048)
    assert [(r.id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(j, s) for s, j in best(usable[0], usable, 4)]
    assert max(abs(r.score) for r in got) > 2**53


def test_the_walk_ends_before_all_vectors_are_seen():
    seen = []

    class Counted(topk.ThresholdSearch):
        def _keep(self, i, ids, scores):
            seen.append(len(ids))
            super()._keep(i, ids, scores)

    class One:
        row, id, label, marks = [0], [-1], [None], [None]
        matrix = np.array([[1000.0, 10.0, 0.0]])

        def __len__(self):
            return 1

    rng = np.random.default_rng(0)
    vectors = np.floor(rng.normal(size=(8000, 3)) * 1000)
    search = Counted(One(), 5)
    search.offer(np.arange(8000), [None] * 8000, vectors)
    scores = vectors @ One.matrix[0]
    assert sorted(search.scores[0].tolist()) == sorted(scores.tolist())[-5:]
    assert sum(seen) < 4000
    walked = sum(seen)
    search.offer(np.arange(8000, 16000), [None] * 8000, np.minimum(vectors, 1500))  # the bound to beat is there already
    assert sum(seen) - walked < 1000


def test_equal_scores_go_to_the_smaller_id_across_batches_and_cells(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(900, -1, -1)]
    got = {r.query_id: [] for r in searched(spark, rows)}
    for r in sorted(searched(spark, rows), key=lambda r: r["rank"]):
        got[r.query_id].append(r.id)
    assert got == {q: [i for i in range(11) if i != q][:10] for q in range(0, 901, 100)}


def test_repeated_rows_are_candidates_as_often_as_they_occur_and_asked_once(spark):
    rows = [(0, [1.0], 0), (0, [1.0], 0), (0, [2.0], 0), (1, [3.0], 0), (1, [3.0], 0), (2, [1.0], 0)]
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in searched(spark, rows, scale=1))
    assert got == sorted((0, r, j, q * s) for q in (1, 2) for r, (j, s) in enumerate([(1, 3), (1, 3), (2, 1)], 1))


# ---------------------------------------------------------------- 12
@pytest.mark.parametrize("size", [1, 3, 200])
@pytest.mark.parametrize("largest", [0, 5, 200, 40_000, 2**31, 2**70])
def test_packed_products_are_exact(size, largest):
    rng = random.Random(size)
    pick = lambda: float(rng.randint(-largest, largest))
    vectors = np.array([[pick() for _ in range(7)] for _ in range(size)])
    for anchor in ([int(pick()) for _ in range(7)], [0] * 7, [-largest] * 7, [largest] * 7):
        got = negatives.PackedProducts(vectors, largest).scores(anchor)
        assert [int(x) for x in got] == [inner(anchor, [int(x) for x in v]) for v in vectors]


def mined(rows, scale, positives, count, low, high):
    usable = [(i, w, label) for i, v, label in rows if i is not None and label is not None and (w := whole(v, scale))]
    out = set()
    for i, q, own in usable:
        if i % 100:
            continue
        same = best((i, q), [(j, v) for j, v, label in usable if label == own], positives)
        other = best((i, q), [(j, v) for j, v, label in usable if label != own], len(usable))
        for p, pid in same:
            within = [(s, j) for s, j in other if low * p <= 100 * s <= high * p][:count]
            out |= {(i, pid, r, j, p, s) for r, (s, j) in enumerate(within, 1)}
    return out


@pytest.mark.parametrize(("seed", "how"), [(4, (256, 5, 10, 30, 90)), (5, (256, 2, 3, 0, 100)), (6, (1024, 300, 300, 50, 60))])
def test_hard_negatives_equal_brute_force(spark, seed, how):
    rows, (scale, positives, count, low, high) = odd_rows(seed), how
    found = negatives.hard_negatives(table(spark, rows), "id % 100 = 0", F.col("label"), scale=scale, positives=positives, count=count,
                                     low=low, high=high).collect()
    got = [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found]
    assert len(got) == len(set(got))
    assert set(got) == mined(rows, scale, positives, count, low, high)


def test_equal_positive_scores_are_positives_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.5, 0.0], 2), (4, [0.5, 1.0], 2), (5, [0.95, 0.0], 2), (6, [0.1, 0.0], 2)]
    got = negatives.hard_negatives(table(spark, rows), "id % 100 = 0", F.col("label")).collect()
    assert sorted((r.positive_id, r["rank"], r.negative_id) for r in got) == [(p, r, n) for p in (1, 2) for r, n in ((1, 3), (2, 4))]


# ---------------------------------------------------------------- both
def test_empty_tables_and_tables_without_queries(spark):
    for rows in ([], [(1, [1.0], 1), (2, [1.0], 1)]):
        assert topk.top_k(table(spark, rows), "id % 100 = 0").collect() == []
        assert negatives.hard_negatives(table(spark, rows), "id % 100 = 0", F.col("label")).collect() == []


def test_several_blocks_groups_and_batches_give_the_same(spark, monkeypatch):
    rows = odd_rows(7)
    one = {(r.query_id, r["rank"], r.id, r.score) for r in topk.top_k(table(spark, rows), "id % 10 = 0").collect()}
    monkeypatch.setattr(cells, "BLOCK", 3)
    monkeypatch.setattr(cells, "GROUP", 20)
    monkeypatch.setattr(cells, "GROUPS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = [(r.query_id, r["rank"], r.id, r.score) for r in topk.top_k(table(spark, rows), "id % 10 = 0").collect()]
        mine = negatives.hard_negatives(table(spark, rows), "id % 100 = 0", F.col("label")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(many) == len(one) and set(many) == one
    assert {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in mine} == mined(rows, 256, 5, 10, 30, 90)
