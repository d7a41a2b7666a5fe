"""Exact best items per user by inner product, pruned by the Cauchy-Schwarz bound.

Items are read in order of falling norm. A user's search is over as soon as norm(user) * norm(next item) is below the n-th score
found: no later item can win. Users are dealt into buckets; a bucket meets the items in that order, in blocks, multiplies a
block with the users still searching, and keeps n items per user. What it holds is one bucket of users and one block of
items, whatever the size of either table. An item of a round goes once to each of its buckets, a user to one.

Items go out in rounds: the first FIRST of them in that order to all buckets, then STEP times as many to the users who are still
searching, and so on. So what is moved follows the depth at which searches end, not the number of items.

Scores are sums in double precision. Equal scores go to the smaller item id. Users and items without factors, or with null or
non-finite ones, take no part; repeated ids count as rows of their own, and so an item may be offered twice if it is given twice.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions.ordering import numbered
from keepwell.session import finished, stored, wide_writes

# task functions travel with their code, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

USERS, LEAST, BLOCK, CHUNK = 262_144, 16, 512, 2_048  #: a user of rank 10 with its 10 best holds about 250 bytes
FIRST, STEP = 16_384, 16  #: items of the first round, and how many times as many the next one has
SAFE = 1 + 1e-9  #: on the bound, for what rounding may take off it
FOUND = "user long, item long, rank int, score double, met long, skipped long"


def _usable(rows: DataFrame, key: str, factors: str, *also: Column) -> DataFrame:
    """(id, factors, norm) and the columns `also`"""
    x = F.col(factors).cast("array<double>")
    norm = F.sqrt(F.aggregate("factors", F.lit(0.0), lambda a, v: a + v * v))
    return rows.select(F.col(key).cast("long").alias("id"), x.alias("factors"), *also).where(
        F.col("id").isNotNull() & (F.size("factors") > 0)).withColumn("norm", norm).where("norm < double('Infinity')")


@dataclass(frozen=True)
class Placed:
    """Items (id, factors, norm) by falling norm, numbered in `place`."""

    rows: DataFrame
    total: int

    def first(self, upto: int) -> DataFrame:
        return self.rows.where(F.col("place") < upto)

    def rest(self, upto: int) -> float:
        """The largest norm from place `upto` on; -1 where there is no such item."""
        found = self.rows.where(F.col("place") == upto).select("norm").first() if upto < self.total else None
        return -1.0 if found is None else found["norm"]


def placed(items: DataFrame, key: str, factors: str = "features") -> Placed:
    rows = numbered(_usable(items, key, factors), [F.desc("norm"), F.col("id")], "place", "items-by-norm")
    return Placed(rows, rows.count())


class Searching:
    """The users of a bucket and the n best items each has met."""

    def __init__(self, ids: np.ndarray, factors: np.ndarray, n: int):
        self.ids, self.factors, self.n = ids, factors, n
        self.norms = np.sqrt((factors * factors).sum(axis=1))
        self.items = np.full((len(ids), n), -1, np.int64)
        self.scores = np.full((len(ids), n), -np.inf)
        self.blocks, self.met = 0, np.zeros(len(ids), np.int64)

    def meet(self, items: np.ndarray, factors: np.ndarray, largest: float) -> None:
        """A block of items; `largest` is the largest norm in it and in all that follow."""
        open_ = np.flatnonzero(self.norms * largest * SAFE >= self.scores[:, -1])
        self.blocks += 1
        self.met[open_] += 1
        order = np.argsort(items, kind="stable")
        items, factors = items[order], factors[order]
        for at in range(0, len(open_), CHUNK):
            self._keep(open_[at:at + CHUNK], items, factors)

    def _keep(self, users: np.ndarray, items: np.ndarray, factors: np.ndarray) -> None:
        scores = self.factors[users] @ factors.T
        better = (scores >= self.scores[users, -1:]).any(axis=1)
        users, scores = users[better], scores[better]
        if not len(users):
            return
        if len(items) > self.n:
            kth = -np.partition(-scores, self.n - 1, axis=1)[:, self.n - 1:self.n]
            ties = (scores >= kth).sum(axis=1) > self.n
            best = np.argpartition(-scores, self.n - 1, axis=1)[:, :self.n]
            if ties.any():  # items stand in order of id, so a stable sort prefers the smaller one
                best[ties] = np.argsort(-scores[ties], axis=1, kind="stable")[:, :self.n]
            scores, found = np.take_along_axis(scores, best, axis=1), items[best]
        else:
            found = np.broadcast_to(items, scores.shape)
        scores, found = np.hstack([self.scores[users], scores]), np.hstack([self.items[users], found])
        order = np.lexsort((found, -scores), axis=-1)[:, :self.n]
        self.scores[users], self.items[users] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(found, order, axis=1)

    def rows(self, rest: float, beyond: int) -> Iterator[pa.RecordBatch]:
        """What the users found whom no item of norm `rest` can serve better, the ids of the others (`open`), and the blocks met and
        skipped, of which `beyond` blocks were not even sent. Rows of one id stay together."""
        names = ["user", "item", "rank", "score", "met", "skipped", "open"]
        open_ = np.isin(self.ids, self.ids[(rest >= 0) & (self.norms * rest * SAFE >= self.scores[:, -1])])
        done = np.flatnonzero(~open_)
        for at in range(0, len(done), CHUNK):
            part = done[at:at + CHUNK]
            user = np.repeat(self.ids[part], self.n)
            rank = np.tile(np.arange(1, self.n + 1, dtype=np.int32), len(part))
            item, score = self.items[part].ravel(), self.scores[part].ravel()
            some = item != -1
            none = pa.nulls(int(some.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(user[some]), pa.array(item[some]), pa.array(rank[some]), pa.array(score[some]), none, none,
                                              pa.array(np.zeros(int(some.sum()), bool))], names=names)
        for ids in np.array_split(np.unique(self.ids[open_]), max(1, len(self.ids) // CHUNK)):
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids), none, pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.float64()), none, none,
                                              pa.array(np.ones(len(ids), bool))], names=names)
        skipped = len(done) * (self.blocks + beyond) - int(self.met[done].sum())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.float64()),
                                          pa.array([int(self.met.sum())], pa.int64()), pa.array([skipped], pa.int64()), pa.array([False])], names=names)


class Counting:
    """The users of a bucket, and how many items score above each one's bar."""

    def __init__(self, ids: np.ndarray, factors: np.ndarray, bars: np.ndarray):
        self.ids, self.factors, self.bars = ids, factors, bars
        self.norms = np.sqrt((factors * factors).sum(axis=1))
        self.above = np.zeros(len(ids), np.int64)

    def meet(self, items: np.ndarray, factors: np.ndarray, largest: float) -> None:
        open_ = np.flatnonzero(self.norms * largest * SAFE >= self.bars)
        for at in range(0, len(open_), CHUNK):
            users = open_[at:at + CHUNK]
            self.above[users] += (self.factors[users] @ factors.T > self.bars[users, None]).sum(axis=1)

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(self.ids), pa.array(self.above)], names=["user", "above"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"factors of different lengths: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _meeting(start: Callable, end: Callable):
    """Rows (bucket, side, place, id, norm, factors, bar) sorted by the first three, users first. `start` takes the ids, factors and bars of
    a bucket's users, what it gives meets the items block by block, and `end` turns it into rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, users, state = None, [], None
        for batch in batches:
            where, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            turns = np.flatnonzero((where[1:] != where[:-1]) | (side[1:] != side[:-1])) + 1
            for first, last in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                if first == last:
                    continue
                if where[first] != bucket:
                    if state is not None:
                        yield from end(state)
                    bucket, users, state = where[first], [], None
                ids = batch.column(3).slice(first, last - first).to_numpy()
                norms = batch.column(4).slice(first, last - first).to_numpy()
                factors = _matrix(batch.column(5).slice(first, last - first))
                if side[first] == 0:
                    users.append((ids, factors, batch.column(6).slice(first, last - first).to_numpy(zero_copy_only=False)))
                    continue
                if users:
                    state, users = start(*(np.concatenate(part) for part in zip(*users, strict=True))), []
                if state is not None:
                    for at in range(0, len(ids), BLOCK):
                        state.meet(ids[at:at + BLOCK], factors[at:at + BLOCK], float(norms[at]))
        if state is not None:
            yield from end(state)
    return run


def _dealt(users: DataFrame, items: DataFrame, bar: Column) -> DataFrame:
    """Users and items in buckets, as `_meeting` takes them."""
    buckets = max(LEAST, math.ceil(users.count() / USERS))
    columns = ["bucket", "side", "place", "id", "norm", "factors", "bar"]
    asked = users.withColumns({"bucket": F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"), "side": F.lit(0), "place": F.lit(0).cast("long"), "bar": bar})
    offered = items.withColumns({"bucket": F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))), "side": F.lit(1), "place": F.col("place").cast("long"),
                                 "bar": F.lit(0.0)})
    met = asked.select(columns).unionAll(offered.select(columns))
    return met.repartition(buckets, "bucket").sortWithinPartitions("bucket", "side", "place")


def searched(users: DataFrame, items: DataFrame | Placed, user_col: str, item_col: str, factors: str = "features", n: int = 10) -> DataFrame:
    """Rows of FOUND: the n best items of every user, and a row per bucket and round with the user-block pairs it `met` and `skipped`."""
    users = _usable(users, user_col, factors)
    items = items if isinstance(items, Placed) else placed(items, item_col, factors)
    columns, parts, upto = [c.split()[0] for c in FOUND.split(", ")], [], FIRST
    while True:
        rest, beyond = items.rest(upto), math.ceil(max(items.total - upto, 0) / BLOCK)
        found = _dealt(users, items.first(upto), F.lit(0.0)).mapInArrow(
            _meeting(lambda ids, x, bars: Searching(ids, x, n), lambda state, rest=rest, beyond=beyond: state.rows(rest, beyond)), f"{FOUND}, open boolean")
        if rest < 0:
            break
        found = stored(found, "searched-round")
        users = users.join(found.where("open").select(F.col("user").alias("id")), "id", "left_semi")
        if users.isEmpty():
            break
        parts.append(found)
        upto *= STEP
    out = found.where("not open").select(columns)
    for part in parts:
        out = out.unionAll(part.where("not open").select(columns))
    return out


def above(users: DataFrame, items: Placed, user_col: str, bar: str, factors: str = "features") -> DataFrame:
    """(user, above): how many of the items score above the user's own `bar`. A user meets the items that the bound can't tell to be
    below it, so a round serves those whose bar no item after it reaches."""
    asked = _usable(users, user_col, factors, F.col(bar).alias("bar"))
    parts, upto, served = [], FIRST, F.lit(False)
    while True:
        rest = items.rest(upto)
        enough = F.lit(True) if rest < 0 else F.col("norm") * F.lit(rest) * F.lit(SAFE) < F.col("bar")
        now = asked.where(enough & ~served)
        parts.append(_dealt(now, items.first(upto), F.col("bar")).mapInArrow(_meeting(Counting, Counting.rows), "user long, above long"))
        if rest < 0 or asked.where(~enough).isEmpty():
            break
        served, upto = enough, upto * STEP
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def in_waves(users: DataFrame, items: DataFrame, user_col: str, item_col: str, path: str, factors: str = "features", n: int = 10,
             waves: int = 4) -> DataFrame:
    """`searched`, a wave of users at a time, each written to `path` when it is done: a run that was stopped goes on with
    the wave it was in. A wave's users are told by a hash of their id, so every run deals them alike."""
    spark = users.sparkSession
    wave = F.pmod(F.xxhash64(F.col(user_col).cast("long"), F.lit(1)), F.lit(waves))
    items = placed(items, item_col, factors)
    for i in range(waves):
        if not finished(spark, f"{path}/wave={i}"):
            found = searched(users.where(wave == i), items, user_col, item_col, factors, n)
            with wide_writes(spark):  # what was shuffled goes with its wave
                found.write.mode("overwrite").parquet(f"{path}/wave={i}")
    return spark.read.schema(f"{FOUND}, wave int").parquet(path)


def best(found: DataFrame) -> DataFrame:
    """(user, item, rank, score)"""
    return found.where("user is not null").select("user", "item", "rank", "score")


def effort(found: DataFrame) -> DataFrame:
    """User-block pairs that were multiplied and skipped, and the share of the latter."""
    total = found.where("user is null").agg(F.coalesce(F.sum("met"), F.lit(0)).alias("met"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))
    return total.withColumn("skipped_share", F.try_divide(F.col("skipped"), F.col("met") + F.col("skipped")))
