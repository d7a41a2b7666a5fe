"""The search in rounds of growing depth, and the audit that proves its result without all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from keepwell.operators import audits, retrieval

KINDS = "id long, features array<double>"


def vectors(seed, n, falling=False):
    rng = random.Random(seed)
    return [(i, [rng.choice((-2.0, -1.0, 0.0, 1.0, 2.0)) * (2.0 ** (5 - i // 24) if falling else 1) for _ in range(4)]) for i in range(n)]


def brute(users, items, n):
    score = lambda x, y: sum(a * b for a, b in zip(x, y, strict=True))
    ranked = {u: sorted((-score(x, y), i) for i, y in items)[:n] for u, x in users}
    return {(u, r, i, round(-s, 9)) for u, best in ranked.items() for r, (s, i) in enumerate(best, 1)}


def got(found):
    return {(r.user, r.rank, r.item, round(r.score, 9)) for r in retrieval.best(found).collect()}


@pytest.fixture
def short(monkeypatch):
    """Rounds of 16, 32, 64 ... items; what was sent is told."""
    for name, value in (("FIRST", 16), ("STEP", 2), ("BLOCK", 8), ("LEAST", 3)):
        monkeypatch.setattr(retrieval, name, value)
    sent, dealt = [], retrieval._dealt

    def told(users, items, bar):
        sent.append((users.count(), items.count()))
        return dealt(users, items, bar)
    monkeypatch.setattr(retrieval, "_dealt", told)
    return sent


def test_rounds_give_the_same_and_end_early(spark, short):
    users, items = [u for u in vectors(1, 60) if any(u[1])], vectors(2, 500, falling=True)
    found = retrieval.searched(spark.createDataFrame(users, KINDS), spark.createDataFrame(items, KINDS), "id", "id", n=5)
    assert got(found) == brute(users, items, 5)
    assert len(short) > 1 and short[-1][0] < short[0][0] == len(users)  # some users were served by the first rounds
    assert max(n for _, n in short) < 500  # the small items went to nobody
    effort = retrieval.effort(found).first()
    assert effort.met + effort.skipped >= len(users) * 63


def test_users_that_nothing_ends_see_all_items(spark, short):
    users = [(1, [0.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 0.0])]  # one id, two rows
    items = [(i, [float(100 - i), 0.0, 0.0, 0.0]) for i in range(100)]
    found = retrieval.searched(spark.createDataFrame(users, KINDS), spark.createDataFrame(items, KINDS), "id", "id", n=2)
    rows = sorted((r.user, r.rank, r.item) for r in retrieval.best(found).collect())
    assert rows == [(1, 1, 0), (1, 2, 1), (2, 1, 0), (2, 1, 0), (2, 2, 1), (2, 2, 1)]
    assert short[-1][1] == 100


def test_audit_of_best_items(spark, short):
    users, items = [u for u in vectors(3, 12) if any(u[1])], vectors(4, 60, falling=True)
    u, v = spark.createDataFrame(users, KINDS), spark.createDataFrame(items, KINDS)
    score = lambda i, j: sum(a * b for a, b in zip(dict(users)[i], items[j][1], strict=True))
    sound = {i: sorted((r, c, s) for a, r, c, s in brute(users, items, 5) if a == i) for i, _ in users}
    ids = iter(sound)
    odd = {next(ids): lambda rows, i: rows[:4],  # an offer fewer
           next(ids): lambda rows, i: [(r - 1, c, s) for r, c, s in rows[1:]],
           next(ids): lambda rows, i: [(6 - r, c, s) for r, c, s in rows],  # the other way round
           next(ids): lambda rows, i: [rows[0], (2, *rows[0][1:]), *rows[2:]],  # an offer twice
           next(ids): lambda rows, i: rows[:4] + [(5, *min(((j, score(i, j)) for j, _ in items), key=lambda x: x[1]))],  # a worse one
           next(ids): lambda rows, i: []}
    raised = next(ids)
    given = {i: odd.get(i, lambda rows, i: rows)(rows, i) for i, rows in sound.items()}
    given[raised] = [(r, c, s + 1) for r, c, s in given[raised]]
    found = spark.createDataFrame([(i, c, r, s) for i, rows in given.items() for r, c, s in rows], "user long, item long, rank int, score double")
    flags = {r.user: (r.offers, r.scores_follow, r.none_better) for r in audits.best_items_follow(found, u, v, 5).collect()}
    assert set(flags) == set(sound)
    assert [flags[i] for i in odd] == [(4, True, False), (4, True, False), (5, True, False), (5, True, False), (5, True, False), (0, False, False)]
    assert flags[raised][1] is False
    assert {flags[i] for i in sound if i not in odd and i != raised} == {(5, True, True)}


def test_fewer_items_than_asked_for_are_all_offered(spark):
    users, items = vectors(5, 6), vectors(6, 3)
    u, v = spark.createDataFrame(users, KINDS), spark.createDataFrame(items, KINDS)
    found = retrieval.best(retrieval.searched(u, v, "id", "id"))
    assert {tuple(r)[1:] for r in audits.best_items_follow(found, u, v, 10).collect()} == {(3, True, True)}
    assert {tuple(r)[1:] for r in audits.best_items_follow(found.where("rank < 3"), u, v, 10).collect()} == {(2, True, False)}
