"""One row per key.

`row_number() = 1` over a total order: Spark keeps at most one row per key and task before the
shuffle (WindowGroupLimit), so a key holding a third of the table does not reach one task.

Keys are sorted by a hash first: a sort compares the first eight bytes of its first column and looks at the row only where they
are equal, and keys such as 'ORD000000000001-1' all begin alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_by_key(df: DataFrame, keys: list[str], order: list, n: int = 1, rank: str = "_rank") -> DataFrame:
    """The first `n` rows of every key under `order`, numbered in `rank`."""
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def latest_by_key(df: DataFrame, key: str, when: str = "_ingested_at") -> DataFrame:
    """Most recently loaded row per key; equal load times are settled by the other columns."""
    others = [c for c in df.columns if c not in (key, when)]
    order = [F.col(c).desc_nulls_last() for c in [when, *others]]
    return top_by_key(df, [key], order).drop("_rank")


def one_by_key(df: DataFrame, key: str) -> DataFrame:
    """Any row per key, made repeatable by taking the largest row."""
    order = [F.col(c).desc_nulls_last() for c in df.columns if c != key]
    return top_by_key(df, [key], order).drop("_rank")
