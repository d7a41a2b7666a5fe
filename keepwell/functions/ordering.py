"""Exact order statistics and global positions without gathering the column anywhere."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from keepwell.session import stored

# task functions travel with their code, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ACCURACY = 20_000
WIDEST = 4_096  #: distinct values that may be left in a bracket when it is ranked


def order_statistics(df: DataFrame, column: str, probs: list[float]) -> list[tuple[float, float, float]]:
    """(lower, upper, weight) around rank (n - 1) * p for each p; empty columns give no tuples.

    A quantile sketch brackets every rank; inside a bracket another sketch narrows it, until at most WIDEST distinct values are
    left. Each round is one pass that returns a few numbers per rank, and shrinks brackets by a factor of thousands, so
    what is ranked in the end is bounded whatever the table's size. A bracket that misses its rank is opened to the nearest known
    bounds and narrowed again: the result is exact. Callers pass a written or cached table.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    whole = values.agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = whole["n"]
    if not n:
        return []
    ranks = [(n - 1) * p for p in probs]
    ends = [(math.floor(r), math.ceil(r)) for r in ranks]
    # per rank: outer bounds known to hold it, and the rows below them
    held = [(whole["lo"], whole["hi"], 0, n, None)] * len(probs)
    v, margin = F.col("v"), 2.0 / ACCURACY
    while any(h[4] is None for h in held):
        wanted = [min(1.0, max(0.0, (r - below) / max(inside, 1) + side * (margin + 2.0 / max(inside, 1))))
                  for (low, high), (_, _, below, inside, _) in zip(ends, held, strict=True) for r, side in ((low, -1), (high, 1))]
        sketches = values.agg(*[
            F.percentile_approx(F.when(v.between(h[0], h[1]), v), wanted[2 * i:2 * i + 2], ACCURACY).alias(f"s{i}") for i, h in enumerate(held)]).first()
        tried = [tuple(s) for s in sketches]
        counts = values.agg(*[c for i, (lo, hi) in enumerate(tried) for c in (
            F.count_if(v < lo).alias(f"below{i}"), F.count_if(v.between(lo, hi)).alias(f"inside{i}"),
            F.approx_count_distinct(F.when(v.between(lo, hi), v), 0.05).alias(f"distinct{i}"))]).first()
        after = []
        for i, ((low, high), old, (lo, hi)) in enumerate(zip(ends, held, tried, strict=True)):
            below, inside, distinct = (counts[f"{k}{i}"] for k in ("below", "inside", "distinct"))
            if old[4] is not None:
                after.append(old)
            elif not below <= low <= high < below + inside:
                after.append(old)  # missed: tried again with a wider margin
                margin *= 16
            else:
                done = lo == hi or distinct <= WIDEST // 2 or (lo, hi) == old[:2]
                after.append((lo, hi, below, inside, True if done else None))
        held = after
    out = []
    for i, ((low, high), (lo, hi, below, _, _)) in enumerate(zip(ends, held, strict=True)):
        left = values.where(v.between(lo, hi)).groupBy("v").agg(F.count("v").alias("rows"))
        ranked = left.withColumn("until", F.lit(below) + F.sum("rows").over(Window.orderBy("v")))
        found = ranked.agg(F.min(F.when(F.col("until") > low, v)), F.min(F.when(F.col("until") > high, v))).first()
        out.append((found[0], found[1], ranks[i] - low))
    return out


def quantiles(df: DataFrame, column: str, probs: list[float]) -> list[float | None]:
    """Exact linearly interpolated quantiles."""
    stats = order_statistics(df, column, probs)
    return [low + (high - low) * weight for low, high, weight in stats] or [None] * len(probs)


DIGIT = 16  #: bits settled per round of `grouped_quantiles`: four rounds for a double
_TOP = np.uint64(1 << 63)


@F.pandas_udf(LongType())
def _image(values: pd.Series) -> pd.Series:
    """The bits of a double, turned so that they order, read without a sign, as the doubles do; both zeros are one."""
    bits = (values.to_numpy(np.float64) + 0.0).view(np.uint64)
    return pd.Series(np.where(bits & _TOP, ~bits, bits | _TOP).view(np.int64))


@F.pandas_udf(DoubleType())
def _value(images: pd.Series) -> pd.Series:
    bits = images.to_numpy(np.int64).view(np.uint64)
    return pd.Series(np.where(bits & _TOP, bits & ~_TOP, ~bits).view(np.float64))


def grouped_quantiles(df: DataFrame, by: list[str], column: str, probs: list[float]) -> DataFrame:
    """(by, n, prob, value): exact linearly interpolated quantiles of every group, for any number of groups and probabilities.

    Radix selection: the ordered bits of a double are settled DIGIT by DIGIT. A round counts, in one aggregate over the rows, the next
    digits behind the prefixes that are still wanted, of all groups and ranks alike, and each rank moves into the digit that
    holds it. Counting combines before the shuffle, so a group may hold any share of the rows, and nothing is ever sorted but
    digits. Nulls and NaN are left out, a null group is a group; groups without values have no row.
    """
    keys = [f"g{i}" for i in range(len(by))]
    rows = stored(df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(column).cast("double").alias("v"))
                  .where("v is not null and not isnan(v)").select(*keys, _image("v").alias("image")), "images")

    def same(left: DataFrame, right: DataFrame, *more: str):
        on = [left[k].eqNullSafe(right[k]) for k in keys] + [left[c] == right[c] for c in more]
        return on or [F.lit(True)]

    rank = (F.col("n") - 1) * F.col("prob")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 0")  # without keys there is always one row
    targets = sizes.select(*keys, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")).select(
        *keys, "n", "prob", F.explode(F.array(F.floor(rank), F.ceil(rank))).alias("place")).distinct()
    targets = stored(targets.withColumns({"left": F.col("place"), "prefix": F.lit(0).cast("long")}), "ranks")
    for settled in range(0, 64, DIGIT):
        prefix = F.shiftrightunsigned("image", 64 - settled) if settled else F.lit(0).cast("long")
        digit = F.shiftrightunsigned("image", 64 - settled - DIGIT).bitwiseAND(F.lit((1 << DIGIT) - 1))
        wanted = targets.select(*keys, "prefix").distinct()
        at = rows.select(*keys, prefix.alias("prefix"), digit.alias("digit"))
        counted = at.join(wanted, same(at, wanted, "prefix"), "left_semi").groupBy(*keys, "prefix", "digit").agg(F.count(F.lit(1)).alias("rows"))
        until = F.sum("rows").over(Window.partitionBy(*keys, "prefix").orderBy("digit"))
        counted = counted.withColumn("until", until)
        holds = (counted["until"] > targets["left"]) & (counted["until"] - counted["rows"] <= targets["left"])
        moved = targets.join(counted, [*same(targets, counted, "prefix"), holds])
        targets = stored(moved.select(*[targets[k] for k in keys], targets["n"], "prob", "place", (F.col("left") - F.col("until") + F.col("rows")).alias("left"),
                                      F.shiftleft(targets["prefix"], DIGIT).bitwiseOR(F.col("digit")).alias("prefix")), "ranks")
    found = targets.select(*keys, "n", "prob", "place", _value("prefix").alias("v"))
    between = F.col("hi") - F.col("lo")
    value = F.when(F.col("hi") == F.col("lo"), F.col("lo")).otherwise(F.col("lo") + between * (rank - F.floor(rank)))
    return found.groupBy(*keys, "n", "prob").agg(F.min_by("v", "place").alias("lo"), F.max_by("v", "place").alias("hi")).select(
        *[F.col(k).alias(b) for k, b in zip(keys, by, strict=True)], "n", "prob", value.alias("value"))


def numbered(df: DataFrame, order: list, name: str, label: str = "numbered") -> DataFrame:
    """0-based position of every row under a total order, for tables of any size.

    A range-partitioned sort gives each task a slice of the order. The sorted rows are written once
    (the slices must not be re-drawn), each slice is counted, and the counts, one per slice, give
    the offsets. No task sees more than its slice.
    """
    saved = stored(df.orderBy(*order).withColumns({
        "_slice": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), label)
    sizes = saved.groupBy("_slice").agg(F.count(F.lit(1)).alias("rows"), F.min("_place").alias("_first"))
    offsets = sizes.withColumn("_offset", F.sum("rows").over(
        Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))).fillna(0, subset=["_offset"]).drop("rows")
    # one row per slice: bounded by the number of shuffle partitions, not by the data
    return (saved.join(F.broadcast(offsets), "_slice")
            .withColumn(name, F.col("_offset") + F.col("_place") - F.col("_first"))
            .drop("_slice", "_place", "_first", "_offset"))
