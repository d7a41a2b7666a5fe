"""Pruned exact search against brute force, with ties, odd rows, waves that were already written, and what was skipped."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keepwell.operators import retrieval

SCHEMA = "id int, features array<float>"


def table(spark, rows, name="id"):
    return spark.createDataFrame(rows, f"{name} long, features array<double>, norm int, place int, bucket int, side int") if rows and len(rows[0]) > 2 else \
        spark.createDataFrame(rows, f"{name} long, features array<double>")


def vectors(seed, n, spread=1, width=4):
    rng = random.Random(seed)
    return [(i, [float(rng.randint(-3, 3)) * (rng.choice((1, 2, 8)) if spread > 1 else 1) for _ in range(width)]) for i in range(n)]


def brute(users, items, n):
    out = set()
    for u, x in users:
        ranked = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in items)[:n]
        out |= {(u, i, r, -s) for r, (s, i) in enumerate(ranked, 1)}
    return out


def rows(found):
    got = [tuple(r) for r in retrieval.best(found).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize(("n_users", "n_items", "n"), [(40, 700, 10), (3, 5, 10), (50, 1500, 1)])
def test_equals_brute_force_with_many_ties(spark, monkeypatch, n_users, n_items, n):
    monkeypatch.setattr(retrieval, "LEAST", 3)
    monkeypatch.setattr(retrieval, "BLOCK", 64)
    users, items = vectors(1, n_users), vectors(2, n_items, 8)
    found = retrieval.searched(table(spark, users), table(spark, items), "id", "id", n=n)
    assert rows(found) == brute(users, items, n)


def test_small_batches_and_blocks_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        users, items = vectors(3, 130), vectors(4, 330, 8)
        assert rows(retrieval.searched(table(spark, users), table(spark, items), "id", "id", n=7)) == brute(users, items, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_items_of_small_norm_are_skipped(spark):
    users = vectors(5, 200)
    items = [(i, [float(2000 - i), 0.0, 0.0, 1.0]) if i < 40 else (i, [0.001, 0.001, 0.0, 0.0]) for i in range(6000)]
    items += [(6000 + i, [-x for x in v]) for i, v in items[:40]] + [(7000 + i, [0.0, s * (900.0 - i), t * 900.0, 0.0]) for i, (s, t) in enumerate(10 * [(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    found = retrieval.searched(table(spark, users), table(spark, items), "id", "id")
    assert rows(found) == brute(users, items, 10)
    effort = retrieval.effort(found).first()
    assert effort.skipped_share > 0.8
    assert effort.met + effort.skipped > 0


def test_odd_rows_take_no_part_and_empty_tables_give_nothing(spark):
    odd = [(None, [1.0, 1.0]), (7, None), (8, []), (9, [None, 1.0]), (10, [float("nan"), 1.0]), (11, [float("inf"), 1.0])]
    users, items = table(spark, [(1, [1.0, 0.0]), *odd]), table(spark, [(5, [2.0, 0.0]), (6, [0.0, 0.0]), *odd])
    assert rows(retrieval.searched(users, items, "id", "id")) == {(1, 5, 1, 2.0), (1, 6, 2, 0.0)}
    nothing = users.where("false")
    assert rows(retrieval.searched(nothing, items, "id", "id")) == rows(retrieval.searched(users, nothing, "id", "id")) == set()


def test_extra_columns_with_clashing_names(spark):
    users = [(i, v, 1, 2, 3, 4) for i, v in vectors(6, 9)]
    items = [(i, v, 1, 2, 3, 4) for i, v in vectors(7, 30)]
    assert rows(retrieval.searched(table(spark, users), table(spark, items), "id", "id", n=3)) == brute([u[:2] for u in users], [i[:2] for i in items], 3)


def test_a_stopped_run_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    users, items = vectors(8, 60), vectors(9, 200, 8)
    search, asked = retrieval.searched, []

    def counted(some, *rest, **how):
        asked.append(some.count())
        if len(asked) == 3:
            raise RuntimeError("executor lost for good")
        return search(some, *rest, **how)
    monkeypatch.setattr(retrieval, "searched", counted)
    path = str(tmp_path / "waves")
    call = lambda: retrieval.in_waves(table(spark, users), table(spark, items), "id", "id", path)
    with pytest.raises(RuntimeError):
        call()
    done = spark.read.parquet(path).where("user is not null").select("user").distinct().count()
    assert 0 < done < 60
    asked[:] = [0, 0, 0]
    found = call()
    assert len(asked) == 5 and sum(asked) == 60 - done  # the two waves that were missing
    assert rows(found) == brute(users, items, 10)


def test_items_are_copied_to_few_buckets_of_many_users(spark):
    """Each bucket costs a copy of all items, so their number should not follow that of the users."""
    users = spark.range(300_000).select("id", F.array(F.lit(1.0), (F.col("id") % 7).cast("double")).alias("features"))
    items = spark.createDataFrame([(1, [2.0, 1.0]), (2, [1.0, 3.0]), (3, [0.5, 0.1])], "id long, features array<double>")
    found = retrieval.searched(users, items, "id", "id", n=1).cache()
    assert found.where("user is null").count() == retrieval.LEAST
    won = {(r.turn, r.item) for r in retrieval.best(found).select((F.col("user") % 7).alias("turn"), "item").distinct().collect()}
    assert won == {(0, 1), *((turn, 2) for turn in range(1, 7))} and retrieval.best(found).count() == 300_000
    found.unpersist()
